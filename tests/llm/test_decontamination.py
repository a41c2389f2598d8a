"""Wu-Manber search against a plain search at every word."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from silverloom.llm import decontamination
from silverloom.llm.queries import op11_wu_manber

_word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    runs = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - size + 1, 1) if w else 0):
            runs.setdefault(tuple(w[k:k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(w) - n + 1):
                who = runs.get(tuple(w[k:k + n]))
                if who:
                    hit.update(range(k, k + n))
                    found |= who
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items, size):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    d = d.select("*", F.lit(1).alias("found"), F.lit("x").alias("words"), F.lit(2).alias("items"), F.lit(3).alias("item"))
    i = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(5).alias("w"), F.lit(6).alias("item"))
    f = F.col("found")
    rows = decontamination.find(d, i, size).select(
        "doc_id", f.n_words, decontamination.hit_words(f), F.size(f["items"]), F.sha2(F.concat_ws(",", f["items"]).cast("binary"), 256),
        decontamination.hit_words(f) > 0)
    return sorted((tuple(r) for r in rows.collect()), key=str)


def corpus(vocabulary):
    r = random.Random(vocabulary)
    draw = lambda n: " ".join(r.choice((f"w{r.randrange(vocabulary)}", f"É{r.randrange(vocabulary)}")) for _ in range(n))
    items = [(k, draw(r.choice((1, 2, 3, 5, 9, 30)))) for k in range(25)]
    items += [(30, None), (31, ""), (32, " .,!"), (None, draw(6)), (33, items[6][1]), (3, draw(12)), (34, "W1 w1-w1 w1 w1 w1 w1"), (34, "W1 w1-w1 w1 w1 w1 w1")]
    docs = [(k, draw(r.choice((0, 1, 4, 40, 200)))) for k in range(60)]
    docs += [(100 + k, f"{draw(7)} {t} , {draw(3)}") for k, (_, t) in enumerate(items) if t]
    docs += [(None, None), (1, ""), (2, "w1 " * 50), (2, "W1.w1\tw1\x00w1" * 9), (200, "a" * 100_000), (201, draw(30_000)), (201, items[6][1].upper())]
    return docs, items


@pytest.mark.parametrize("vocabulary, size", [(2, 4), (6, 3), (300, 10), (40, 1)])
def test_equals_search_at_every_word(spark, vocabulary, size):
    docs, items = corpus(vocabulary)
    assert found(spark, docs, items, size) == brute(docs, items, size)


def test_several_blocks_and_pieces_change_nothing(spark, monkeypatch):
    docs, items = corpus(4)
    monkeypatch.setattr(decontamination, "BLOCK_ROWS", 40)
    assert found(spark, docs, items, 5) == brute(docs, items, 5)


def test_pieces_of_a_long_text():
    docs, items = corpus(5)
    runs = [(str(i), " ".join(w[k:k + 4])) for i, t in items for w in [words(t)] for k in range(max(len(w) - 3, 1) if w else 0)]
    search = decontamination.Searcher(runs)
    whole = [search(t) for _, t in docs]
    try:
        decontamination.PIECE, kept = 7, decontamination.PIECE
        assert [search(t) for _, t in docs] == whole
    finally:
        decontamination.PIECE = kept


def test_nothing_to_find_and_nowhere_to_look(spark):
    docs, items = corpus(3)
    assert found(spark, docs[:5], [], 10) == brute(docs[:5], [], 10)
    assert found(spark, [], items, 10) == []


def test_registered_query_over_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in op11_wu_manber(spark, folder).collect()), key=str)
    assert got == brute(docs, items, 10)
    assert any(r[-1] for r in got)
