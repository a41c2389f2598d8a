"""Packing: exact round trips and plain best fit. Mixing: budgets and epochs against a plain version."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverloom.llm import mixing, packing


def filled(places):
    """Sequences as lists of (offset, length), from the places of a plan."""
    out = defaultdict(list)
    for length, first, until, sequence, per, offset in places:
        for k in range(until - first):
            out[sequence + k // per].append((offset + k % per * length, length))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.just(30))
def test_plan_places_every_piece_once_without_gaps(lengths, capacity):
    places = packing.plan(dict(Counter(lengths)), capacity)
    assert Counter({x: sum(b - a for length, a, b, *_ in places if length == x) for x in set(lengths)}) == Counter(lengths)
    for length in set(lengths):
        spans = sorted((a, b) for x, a, b, *_ in places if x == length)
        assert [a for a, _ in spans] == [0, *[b for _, b in spans][:-1]]
    used = filled(places)
    assert sorted(used) == list(range(len(used)))
    for held in used.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(n for _, n in held) <= capacity
        assert sum(3 * n > capacity for _, n in held) <= 2


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(5))
def test_plan_needs_about_as_few_sequences_as_best_fit(seed):
    r = random.Random(seed)
    lengths = [min(2048, int(r.lognormvariate(6, 1)) + 1) for _ in range(2000)]
    n = len(filled(packing.plan(dict(Counter(lengths)))))
    assert -(-sum(lengths) // 2048) <= n <= 1.01 * best_fit_decreasing(lengths, 2048) + 1


def test_packed_rows_give_the_documents_back(spark):
    texts = ["", None, "one", "one two", "<|endoftext|>", "über  zwei\n\nZeilen ", "word " * 5000, "x" * 3000, "one", "あ" * 900]
    df = spark.createDataFrame([(k, t, 9, "s") for k, t in enumerate(texts)] + [(0, "", 9, "s"), (None, "no id", 9, "s")],
                               "doc_id long, text string, length int, task string").repartition(3)
    rows = packing.pack(packing.pieces(df)).collect()
    docs, places = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    assert docs.pop(None)
    for k, parts in docs.items():
        parts.sort()
        want = plain.encode(texts[k] or "", add_special_tokens=False).ids + [0]
        if k == 0:  # stands twice
            assert parts == [parts[0]] * 2
            parts = parts[:1]
        assert [p for p, *_ in parts] == list(range(len(parts)))
        assert np.frombuffer(b"".join(b for *_, b in parts), "<u4").tolist() == want
        assert [n for _, _, n, _ in parts] == packing.cut(len(want), 2048)
        assert [s for _, s, *_ in parts] == np.cumsum([0] + [n for _, _, n, _ in parts])[:-1].tolist()
    for held in places.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(n for _, n in held) <= 2048
    assert packing.pack(packing.pieces(df.limit(0))).count() == 0


@pytest.mark.parametrize("text", ["a " + " " * 2_000_000 + "b", "\n" * 1_000_000, ("x" + "\u3000" * 99_999) * 3])
def test_very_long_white_space_is_encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = np.frombuffer(packing.public_encoder()(text), "<u4")
    assert got.tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.integers(0, 50), st.floats(0, 5)), min_size=1), st.integers(0, 200))
def test_fill_uses_all_it_can(children, total):
    limits, wanted = {n: a for n, (a, _) in children.items()}, {n: w for n, (_, w) in children.items()}
    got = mixing.fill(total, wanted, limits)
    assert sum(got.values()) == min(total, sum(limits.values()))
    assert all(0 <= got[n] <= limits[n] for n in got)


def test_shortage_goes_to_siblings_first():
    tokens = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000}
    got = mixing.budgets(tokens, {("a",): 1.0, ("b",): 1.0}, 400, 1)
    assert got == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 200}
    got = mixing.budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 1000}, {}, 400, 1)
    assert got == {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 370}
    assert mixing.budgets({}, {}, 10, 1) == {}


def test_epochs_are_whole_orders_and_a_prefix(spark):
    r = random.Random(2)
    rows = [(k, r.choice(["de", "en", None]), r.choice(["s1", "s2"]), r.randrange(0, 40)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, words int").withColumn("_leaf", F.lit("extra column")).withColumn("_range", F.lit(1))
    mix = lambda seed: mixing.mix(df, [F.col("lang"), F.col("source")], F.col("words"), {("de",): 5.0}, 1.2, 3, seed).collect()
    got = mix(1)
    sizes = Counter()
    for _, lang, source, n in rows:
        sizes[(lang or "(null)", source)] += n
    want = mixing.budgets(dict(sizes), {("de",): 5.0}, int(1.2 * sum(sizes.values())), 3)
    taken, epochs = Counter(), defaultdict(set)
    for x in got:
        taken[tuple(x["_leaf"].split("/"))] += x["_taken"]
        epochs[(x["_leaf"], x["_epoch"])].add(x["_row"]["doc_id"])
        assert 0 <= x["_taken"] <= x["_tokens"]
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in want.items() if v}
    all_ids = {k: {i for i, lang, s, _ in rows if (lang or "(null)", s) == k} for k in sizes}
    for path, budget in want.items():
        leaf, full = "/".join(path), budget // sizes[path]
        assert all(epochs[(leaf, e)] == all_ids[path] for e in range(full))
        part = [x for x in got if x["_leaf"] == leaf and x["_epoch"] == full]
        assert sum(x["_taken"] < x["_tokens"] for x in part) <= 1
    assert sorted(map(str, mix(1))) == sorted(map(str, got)) and sorted(map(str, mix(2))) != sorted(map(str, got))
    empty = mixing.mix(df.limit(0), [F.col("lang")], F.col("words"), {}, 0.5, 3)
    assert empty.count() == 0


def test_words_are_counted_over_whole_texts(spark):
    df = spark.createDataFrame([("a b  c\n",), ("",), (None,), (" \t ",), ("x",), ("y " * 100_000,)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == [3, 0, 0, 0, 1, 100_000]
