"""Benchmark decontamination: many test strings at once by the Wu-Manber search.

Texts are sequences of words, and words are the signs the search works on. Test strings of one length share a table of
shifts: how far the text may move on when its last two words read are these. Where the shift is nothing, the bucket of
those two words holds the test strings that end with them, and equality decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.storage import stored

BLOCK_ROWS, BLOCK_BYTES = 100_000, 16_000_000  # test strings that are searched for at once; more take another round
PIECE = 1_000_000  # bytes of a text that are cut into words at once

_SIGNS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in pieces, so that a very long text is never a list as a whole. In UTF-8 every sign beyond ASCII
    is made of bytes beyond ASCII, so cutting bytes cuts at the same places."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_SIGNS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Patterns:
    """Test strings of one length, in words."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.farthest = length - self.block + 1
        self.shifts: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list]] = defaultdict(dict)

    def add(self, words: list[bytes], item) -> None:
        for end in range(self.block, self.length + 1):
            key = b" ".join(words[end - self.block:end])
            self.shifts[key] = min(self.shifts.get(key, self.farthest), self.length - end)
        self.buckets[b" ".join(words[-self.block:])].setdefault(b" ".join(words), []).append(item)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """(first word, items) of every occurrence."""
        shifts, farthest, length, two = self.shifts, self.farthest, self.length, self.block == 2
        last, n = length - 1, len(words)
        while last < n:
            key = words[last - 1] + b" " + words[last] if two else words[last]
            shift = shifts.get(key, farthest)
            if shift:
                last += shift
                continue
            items = self.buckets[key].get(b" ".join(words[last - length + 1:last + 1]))
            if items is not None:
                yield last - length + 1, items
            last += 1


class Searcher:
    """All test strings of a block."""

    def __init__(self, rows: Iterable[tuple[str | None, str]]):
        classes: dict[int, Patterns] = {}
        for item, text in rows:
            words = text.encode("utf-8").split(b" ")
            classes.setdefault(len(words), Patterns(len(words))).add(words, item)
        self.classes = [classes[k] for k in sorted(classes)]
        self.overlap = max(classes, default=1) - 1

    def __call__(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """(words, stretches of words inside occurrences, items). Stretches are in order and do not touch."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        held: list[bytes] = []
        first = total = 0
        for piece in word_lists(text):
            words = held + piece
            for c in self.classes:
                spans += joined((first + at, first + at + c.length) for at, found in c.search(words) if not items.update(found))
            total = first + len(words)
            held = words[len(words) - min(self.overlap, len(words)):]
            first = total - len(held)
        return total, joined(sorted(spans)), items - {None}


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in order of their start, with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words) of every run of ``size`` consecutive words of an item, each once; an item of fewer words is one run."""
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    words = items.select(F.col(id_col).cast("string").alias("item"), found.alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(size - 1), F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.concat_ws(" ", F.slice("w", i, F.lit(size))))).alias("words")).distinct()


FOUND = "n_words long, starts array<long>, ends array<long>, items array<string>"


def _searched(block: list[tuple[str | None, str]], spark):
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        search = Searcher(shared.value)
        for texts, before in batches:
            rows = []
            for text, starts, ends, items in zip(texts, before["starts"], before["ends"], before["items"]):
                n, spans, found = search(text)
                spans = joined(sorted(spans + list(zip(starts, ends)))) if len(starts) else spans
                rows.append((n, [s for s, _ in spans], [e for _, e in spans], sorted(found.union(items))))
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return run


def find(docs: DataFrame, items: DataFrame, size: int = 10, text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """The documents with a column ``found``: ``n_words``, ``starts`` and ``ends`` (stretches of words, from 0 and ends left
    out, that lie inside occurrences of item windows, merged and in order), ``items`` (ids of the items as text, sorted).

    Words are lower-cased in A-Z only. Items are searched for in blocks of bounded size, dealt by a hash of item and window;
    each further block takes a round over the documents, so there may be any number of items. Null and empty texts have no
    words. Items without words fit nowhere; those with a null id mark words and have no name; an id that repeats counts
    once. Documents stay as they are, with repeated and null ids and whatever columns they have, one row each; a column
    called ``found`` is replaced.
    """
    spark = docs.sparkSession
    strings = stored(windows(items, size, item_id, item_text))
    n, weight = strings.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_ROWS), -(-weight // BLOCK_BYTES), 1)
    nothing = F.struct(
        F.lit(0).cast("long").alias("n_words"),
        *[F.array().cast(f"array<{kind}>").alias(name) for name, kind in (("starts", "long"), ("ends", "long"), ("items", "string"))])
    rows = docs.withColumn("found", nothing)
    for k in range(blocks):
        block = strings.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k).collect()
        rows = rows.withColumn("found", _searched([tuple(r) for r in block], spark)(F.col(text_col), F.col("found")))
        if k + 1 < blocks:
            rows = stored(rows)
    return rows


def hit_words(found: Column) -> Column:
    """How many words lie inside occurrences."""
    zero = F.lit(0).cast("long")
    return F.aggregate(found["ends"], zero, lambda a, x: a + x) - F.aggregate(found["starts"], zero, lambda a, x: a + x)
