"""Spelling variants by a permuterm index.

A word with an end mark is turned round at every place. The turn that brings a letter to the end begins with all other
signs of the word, so words that differ in that one letter share this beginning; and a word that has one letter less has
the beginning itself as one of its own turns. All turns are sorted and the groups of equal beginnings read in one pass: a
group has one row for each letter that can stand there and one for the shorter word, and what leaves it are a count and
the best neighbour of each member, never pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.storage import stored

#: A turn of a long word is too much text to be sorted, so it stands as four polynomials (124 bits), which follow from those
#: of the word's beginnings. Primes below 2^31 and bases, chosen freely; the mark is no code point.
PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], dtype=np.uint64)
BASES = np.array([1103515245, 1597334677, 747796405, 1181783497], dtype=np.uint64)
MARK = np.uint64(0x110001)
SKIP, SKIP_FIRST, WHOLE = 0, 1, 2  # a letter left out, the first of a run of equal ones left out, nothing left out
AT_ONCE = 100_000  # signs that are worked on at once
HELD = 200_000  # words that a task counts before it passes them on

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 32 for b in range(256))


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF in Latin-1, A-Z lowered."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def count_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text_col: str = "text",
                change: Callable[[str, bytes], bytes] | None = None) -> DataFrame:
    """(word, n) of the words of whole texts with at least so many letters and occurrences. ``change`` may rewrite a run
    (id of its document as text, run in Latin-1) and make it shorter, not longer. A null id is the empty text, null texts
    have no words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["doc"], batch["text"]):
                found = [w for w in letter_runs(text) if len(w) >= least_length]
                counts.update(w for w in (change(doc, w) for w in found) if len(w) >= least_length) if change else counts.update(found)
                if len(counts) >= HELD:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.col(text_col).alias("text"))
    return texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _counted(counts: Counter) -> pd.DataFrame:
    words = pd.Series([w.decode("latin-1") for w in counts], dtype=object)
    return pd.DataFrame({"word": words, "n": pd.Series(counts.values(), dtype="int64")})


def turns(codes: np.ndarray, ids: np.ndarray) -> Iterator[pd.DataFrame]:
    """(k1, k2, v) of every turn of words of one length, given as rows of code points; v is four times the id and the kind."""
    n, length = codes.shape
    powers = np.empty((length + 2, 4), dtype=np.uint64)
    powers[0] = 1
    for j in range(length + 1):
        powers[j + 1] = powers[j] * BASES % PRIMES
    begins = np.zeros((length + 1, n, 4), dtype=np.uint64)
    for j in range(length):
        begins[j + 1] = (begins[j] * BASES + codes[:, j, None]) % PRIMES
    step = max(1, AT_ONCE // n)
    for at in range(0, length + 1, step):
        places = np.arange(at, min(at + step, length + 1))
        for left_out in (0, 1):
            i = places[places + left_out <= length]
            if not len(i):
                continue
            # what follows the place, the mark, what stands before it
            rest = (begins[length] + PRIMES - begins[i + left_out] * powers[length - i - left_out][:, None] % PRIMES) % PRIMES
            h = (((rest * BASES + MARK) % PRIMES) * powers[i][:, None] + begins[i]) % PRIMES
            kind = np.full((len(i), n), WHOLE, dtype=np.int64)
            if left_out:
                kind[:] = (i[:, None] == 0) | (codes[:, i].T != codes[:, np.maximum(i - 1, 0)].T)
            yield pd.DataFrame({
                "k1": (h[..., 0] << np.uint64(31) | h[..., 1]).astype(np.int64).ravel(),
                "k2": (h[..., 2] << np.uint64(31) | h[..., 3]).astype(np.int64).ravel(), "v": (ids[None, :] * 4 + kind).ravel()})


def _all_turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for length, rows in batch.groupby(batch["word"].str.len()):
            if length == 0:
                continue
            some = max(1, AT_ONCE // length)
            for at in range(0, len(rows), some):
                part = rows.iloc[at:at + some]
                codes = np.frombuffer("".join(part["word"]).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(part), length)
                yield from turns(codes.astype(np.uint64) + np.uint64(1), part["id"].to_numpy())


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups of sorted turns, those cut by the end of a batch put together again."""
    held = None
    for batch in batches:
        rows = np.stack([batch[c].to_numpy() for c in ("k1", "k2", "v")])
        rows = rows if held is None else np.concatenate((held, rows), axis=1)
        if not rows.shape[1]:
            continue
        starts = np.flatnonzero(np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0))))
        yield _neighbours(rows[:, :starts[-1]], starts[:-1])
        held = rows[:, starts[-1]:]
    if held is not None:
        yield _neighbours(held, np.array([0]))


def _neighbours(rows: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
    """(id, n_near, best) of the members of groups that have a neighbour in them; the best is the smallest id."""
    if not len(starts):
        return pd.DataFrame({"id": [], "n_near": [], "best": []}, dtype="int64")
    ids, kind = rows[2] >> 2, rows[2] & 3
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.shape[1])))
    none = np.iinfo(np.int64).max
    skip, first, whole = kind != WHOLE, kind == SKIP_FIRST, kind == WHOLE

    def best(of: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(np.where(of, ids, none), starts)[group]

    n_skip, n_first = (np.add.reduceat(of.astype(np.int64), starts)[group] for of in (skip, first))
    shorter, longer, top = best(whole), best(first), best(skip)
    second = best(skip & (ids != top))
    n = np.where(whole, n_first, n_skip - 1 + (first & (shorter != none)))
    beside = np.where(ids == top, second, top)
    found = np.where(whole, longer, np.where(first, np.minimum(beside, shorter), beside))
    keep = n > 0
    return pd.DataFrame({"id": ids[keep], "n_near": n[keep], "best": found[keep]})


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best) of the words (id, word), distinct, that another word is near to: one code point inserted, deleted
    or replaced. ``best`` is the smallest id among those."""
    sorted_turns = words.select("id", "word").mapInPandas(_all_turns, "k1 long, k2 long, v long").repartition("k1").sortWithinPartitions("k1", "k2", "v")
    found = sorted_turns.mapInPandas(_scan, "id long, n_near long, best long")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of (word, n).

    The form is the near word of largest n, the first in code-point order among equals, if that n is at least ``ratio``
    times the word's own; the root is where forms lead, the word itself if it has none. Counts at least double along forms
    (``ratio`` is 2 or more), so they end. Words that repeat have their counts added; null words are left out, and the empty word is near to none.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 or more")
    merged = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    # numbers in this order: the smaller of two is the better form
    ranked = stored(merged.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()))
    near = stored(near_words(ranked))
    forms = ranked.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    own = stored(
        ranked.join(near, "id", "left").join(forms, "best", "left")
        .withColumn("has", F.coalesce(F.col("form_n") >= F.col("n") * ratio, F.lit(False)))
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                *[F.when(F.col("has"), F.col(c)).alias(a) for c, a in (("best", "to"), ("form", "form"), ("form_n", "form_n"))]))
    ends = _ends(own.filter("to IS NOT NULL").select("id", "to"))
    roots = ranked.select(F.col("id").alias("end"), F.col("word").alias("root"))
    return (
        own.join(ends.select("id", F.col("to").alias("end")), "id", "left").join(roots, "end", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _ends(links: DataFrame) -> DataFrame:
    """Links (id, to) led on to where they end; each round doubles the way."""
    while True:
        ahead = links.select(F.col("id").alias("to"), F.col("to").alias("next"))
        led = stored(links.join(ahead, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        links = led.select("id", "to")
        if led.filter("moved").isEmpty():
            return links
