"""Orchard's search and the codebooks against measuring every entry."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverloom.llm import vector_codes


@pytest.mark.parametrize("spread", [3, 40, 100_000])
def test_search_finds_the_nearest_entry_and_the_lower_of_ties(spread):
    g = np.random.default_rng(spread)
    for k in (1, 2, 7, 64):
        entries = g.integers(-spread, spread + 1, size=(k, 3))
        points = g.integers(-2 * spread, 2 * spread + 1, size=(3000, 3))
        away = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        index, distance = vector_codes.Codebook(entries).nearest(points)
        assert (index == away.argmin(axis=1)).all() and (distance == away.min(axis=1)).all()


def brute(rows, parts, size, rounds, scale):
    good = [(i, [int(np.floor(float(x) * scale)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    fits = sorted((r for r in good if r[1] and len(r[1]) % parts == 0), key=lambda r: (r[0] is None, r[0], rows[0] and r[1]))
    width = len(fits[0][1]) if fits else 0
    taken = [r for r in fits if len(r[1]) == width and max(map(abs, r[1])) < 10 ** 6]
    w = width // parts if width else 0
    books = [[r[1][p * w:(p + 1) * w] for r in taken[:size]] for p in range(parts)] if taken else []

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for r in taken:
                x = r[1][p * w:(p + 1) * w]
                members.setdefault(near(book, x)[1], []).append(x)
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, label in good:
        code = error = None
        if len(v) == width and max(map(abs, v), default=10 ** 9) < 10 ** 6:
            found = [near(book, v[p * w:(p + 1) * w]) for p, book in enumerate(books)]
            code, error = "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)
            sums[label] = sums.get(label, 0) + error
        out.append((i, code, error, label))
    return sorted(((i, c, e, sums.get(label), digest) for i, c, e, label in out), key=str)


def check(spark, rows, parts, size, rounds, scale=16):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.select("*", F.lit(1).alias("id"), F.lit("x").alias("vector"), F.lit(2).alias("of"), F.lit(3).alias("code"), F.lit(4).alias("error"))
    got = sorted((tuple(r) for r in vector_codes.encode(df, parts, size, rounds, scale).collect()), key=str)
    assert got == brute(rows, parts, size, rounds, scale)
    return got


def vectors(n, width, seed):
    g = np.random.default_rng(seed)
    return [(int(k), [float(x) for x in g.normal(size=width)], None if k % 5 == 0 else int(k % 3)) for k in range(n)]


def test_equals_brute_force_on_every_kind_of_row(spark):
    rows = vectors(200, 8, 1)
    rows += [(3, rows[3][1], 1)] * 40 + [(2, rows[9][1], None)]  # repeated rows, an id with another vector
    rows += [(None, rows[5][1], 2), (300, None, 1), (301, [float("nan")] * 8, 1), (302, [float("inf")] + [0.0] * 7, 1), (303, [None] + [0.0] * 7, 1)]
    rows += [(304, [1.0, 2.0], 1), (305, [], 9), (306, [0.5] * 16, None), (307, [-1e300] * 8, 1), (308, [-0.0] * 8, 7)]
    check(spark, rows, 4, 16, 2)


def test_fewer_rows_than_entries_and_none(spark):
    check(spark, vectors(5, 8, 2), 4, 16, 2)
    check(spark, [(1, [1.0] * 4, None)] * 3, 2, 4, 2)
    check(spark, [(1, [1.0, 2.0, 3.0], None), (2, None, 1)], 2, 4, 2)
    check(spark, [], 2, 4, 2)


def test_batches_walk_alike(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "AT_ONCE", 7)
    check(spark, vectors(60, 8, 3), 2, 8, 3)
