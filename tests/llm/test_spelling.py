"""Permuterm turns against comparing every word with every other."""

import random
import zlib

import pytest

from silverloom.llm import spelling
from silverloom.llm.queries import letter_dropped


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(counts, ratio):
    beside = {a: [b for b in counts if near(a, b)] for a in counts}
    form = {}
    for a, others in beside.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= ratio * counts[a] else None
    out = []
    for a in counts:
        root = a
        while form[root] is not None:
            root = form[root]
        out.append((a, form[a], root, counts[a], len(beside[a]), form[a] and counts[form[a]]))
    return sorted(out, key=str)


def made(letters, n, seed, longest=7):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.randrange(1, longest))) for _ in range(n)}
    return {w: r.choice((2, 2, 3, 20, 30, 200, 200, 2000)) for w in words}


@pytest.mark.parametrize("letters, at_once", [("ab", 100_000), ("abcdé", 7), ("ab中𐍈", 100_000)])
def test_equals_all_pairs(spark, monkeypatch, letters, at_once):
    monkeypatch.setattr(spelling, "AT_ONCE", at_once)
    counts = made(letters, 300, 1)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted((tuple(r) for r in spelling.variants(df).collect()), key=str) == brute(counts, 10)


def test_groups_cut_by_batches_are_put_together(spark):
    counts = made("abc", 400, 2, 5)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = sorted((tuple(r) for r in spelling.variants(df, 2).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert got == brute(counts, 2)


def test_long_empty_null_and_repeated_words(spark):
    long = "ab" * 20_000
    rows = [(long, 500), (long[:-1], 3), ("x" + long[1:], 2), ("", 4), ("a", 4), (None, 9), ("aa", 1), ("aa", 1)]
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {
        long: (None, long, 500, 2, None), long[:-1]: (long, long, 3, 1, 500), "x" + long[1:]: (long, long, 2, 1, 500),
        "": (None, "", 4, 0, None), "a": (None, "a", 4, 1, None), "aa": (None, "aa", 2, 1, None)}
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def plain_runs(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
            run += c.lower() if c <= "Z" else c
        else:
            out += [run] if run else []
            run = ""
    return out


def test_counts_of_whole_texts(spark):
    r = random.Random(3)
    signs = "abcÉ÷Zß -1ĀŒ中\n"
    docs = [(k, "".join(r.choice(signs) for _ in range(r.choice((0, 10, 4000))))) for k in range(80)] + [(5, None), (None, "abcabcabc " * 9), (7, "a" * 300_000)] * 2
    want = {}
    for doc, text in docs:
        for run in plain_runs(text):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                want[word] = want.get(word, 0) + 1
    want = {w: n for w, n in want.items() if n >= 2}
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    assert {x["word"]: x["n"] for x in spelling.count_words(df, 7, 2, change=letter_dropped).collect()} == want
    assert spelling.count_words(df.limit(0), 7, 2).count() == 0
