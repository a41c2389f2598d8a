"""Odd sketches: pairs, groups and odd rows against brute force over all pairs."""

import random

import pytest

from silverloom.llm import odd_sketch
from tests.llm.test_vectors_and_search import brute_components


def words(text):
    out, at = [], []
    for ch in (text or ""):
        if ch in " \t\n\x0b\x0c\r":
            if at:
                out.append("".join(at))
            at = []
        else:
            at.append(ch.lower() if "A" <= ch <= "Z" else ch)
    return out + (["".join(at)] if at else [])


def brute_set(text, size):
    w = words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent):
    sets = {i: brute_set(t, size) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = brute_components(sets, links)
    return sorted((i, len(sets[i]), label[i], i == label[i]) for i in sets)


def corpus():
    r = random.Random(4)
    vocab = [f"w{k}" for k in range(400)]
    base = [" ".join(r.choice(vocab) for _ in range(n)) for n in (5, 20, 60, 150, 400)]
    rows = []
    for k in range(260):
        w = base[k % 5].split()
        for _ in range(r.choice((0, 0, 1, 2, 4, 8))):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append(" ".join(w))
    rows += ["", None, "   ", "one", "One", "one two", "ONE\ttwo", "one two three", "é è É", "é è é", "a" * 200_000, " ".join(vocab * 40), " ".join(vocab * 40) + " end"]
    rows += [base[2]] * 40  # a group of copies
    return list(enumerate(rows))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_equals_all_pairs(spark, size, percent):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, component int")
    assert sorted(tuple(r) for r in odd_sketch.near_duplicates(df, size, percent).collect()) == brute(rows, size, percent)


def test_chain_whose_ends_do_not_meet_the_smallest(spark, monkeypatch):
    """Each neighbour is similar, the ends are not: the group's smallest document does not link all of them."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 7)
    w = [f"v{k}" for k in range(400)]
    rows = [(k, " ".join(w[3 * k:3 * k + 100])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in odd_sketch.near_duplicates(df, 3, 85).collect()) == brute(rows, 3, 85)


def test_repeated_rows_null_ids_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c")], "doc_id long, text string")
    assert sorted(tuple(r) for r in odd_sketch.near_duplicates(df, 3, 85).collect()) == [(1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False)]
    assert odd_sketch.near_duplicates(df.limit(0), 3, 85).count() == 0


def test_sketches_estimate_high_similarity():
    r = random.Random(1)
    a = odd_sketch.shingles(" ".join(str(r.random()) for _ in range(2000)), 3, odd_sketch._Words())
    from math import log
    for share in (0.95, 0.9, 0.85):
        keep = int(len(a) * 2 * share / (1 + share))
        b = odd_sketch.np.concatenate((a[:keep], odd_sketch._mixed(a[keep:] + odd_sketch.np.uint64(9))))
        x, y = (int.from_bytes(odd_sketch.signature(odd_sketch.np.unique(s))[1], "big") for s in (a, b))
        apart = (x ^ y).bit_count()
        assert abs(1 + odd_sketch.SKETCH_BITS / (4 * odd_sketch.SAMPLES) * log(1 - 2 * apart / odd_sketch.SKETCH_BITS) - share) < 0.12
        assert apart <= odd_sketch.most_differing(share)
