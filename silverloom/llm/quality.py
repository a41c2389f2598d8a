"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

A text's features are its words and pairs of neighbouring words, hashed into ``2 ** BITS`` places; each counts as its share
of the text. The model learns on a bounded sample of labelled rows, in shards whose weights are averaged, and scores whole
texts as a sparse dot product.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.folds import sampled_labels

BITS = 18
SAMPLE = 12_000  # labelled rows learned from, at most
SHARD = 1_500  # rows learned from in one task
EPOCHS, UPDATES = 3, 4_500  # passes over a shard at least, and updates at least where it is small
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
SCALES = 16.0, 48.0  # what the shares of a text's words add up to, and those of its pairs
CACHED_WORDS = 200_000

_token = re.compile(r"\w+|[^\w\s]+")
_mask = np.uint32((1 << BITS) - 1)
_same = np.uint32(zlib.crc32(b"the word before"))


class _Words(dict):
    """The hashes of what a word between blanks holds: runs of letters or digits, runs of other signs, all capitals."""

    def __missing__(self, word: str) -> bytes:
        parts = _token.findall(word.lower()) + ["CAPITALS"] * (len(word) > 1 and word.isupper())
        hashes = array("I", [zlib.crc32(p.encode("utf-8", "replace")) for p in parts]).tobytes()
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = hashes
        return hashes


def features(text: str, words: dict) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of the words, and of the pairs. A word that repeats the one before it makes the same pair whatever it is, and
    does not count as a word again. And the number of words."""
    one = np.frombuffer(b"".join(map(words.__getitem__, text.split())), dtype=np.uint32)
    a, b = one[:-1], one[1:]
    two = np.where(a == b, _same, (a * np.uint32(2654435761)) ^ ((b << np.uint32(7)) | (b >> np.uint32(25))))
    return np.concatenate((one[:1], b[a != b])) & _mask, two & _mask, len(one)


def _shares(text: str, words: dict) -> tuple[np.ndarray, np.ndarray]:
    places, shares = [np.array([1 << BITS])], [np.array([1.0])]  # the last place is the constant
    one, two, length = features(text, words)
    for got, scale in zip((one, two), SCALES):
        if len(got):
            at, n = np.unique(got, return_counts=True)
            places.append(at.astype(np.int64))
            shares.append(n * (scale / length))
    at, where = np.unique(np.concatenate(places), return_inverse=True)
    return at, np.bincount(where, np.concatenate(shares))


def train_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """(place, weight) other than 0 after some passes over the rows (doc_id, text, label), each in an order of its own."""
    words, z, n = _Words(), np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = rows.sort_values(["doc_id", "label", "text"])
    made = [(*_shares(t, words), y) for t, y in zip(order["text"], order["label"])]
    for epoch in range(max(EPOCHS, -(-UPDATES // len(made)))):
        for k in np.random.default_rng(epoch).permutation(len(made)):
            at, x, y = made[k]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    place = np.flatnonzero(n)
    weight = weights(place)
    return pd.DataFrame({"place": place[weight != 0], "weight": weight[weight != 0]})


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label_col: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights, the constant's last, averaged over the shards. Labels other than 0 and 1 and null texts teach nothing;
    without any labelled text all weights are 0 and every score is a half."""
    picked = sampled_labels(labels, label_col, may_learn, sample)
    shards = max(1, -(-picked.count() // SHARD))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").filter("text IS NOT NULL")
    parts = (
        rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)))
        .groupBy("shard").applyInPandas(train_shard, "place long, weight double")
        .groupBy("place").agg(F.sum("weight").alias("weight")).collect()  # no more than 2 ** BITS + 1 rows
    )
    out = np.zeros((1 << BITS) + 1)
    for r in parts:
        out[r["place"]] = r["weight"] / shards
    return out


def score(weights: np.ndarray, spark) -> callable:
    """A column function: the probability of label 1 for whole texts; null counts as empty, which the constant decides."""
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, words = shared.value, _Words()
        table, constant = w[:-1], float(w[-1])

        def one(text) -> float:
            total = constant
            one, two, length = features(text if isinstance(text, str) else "", words)
            if length:
                total += SCALES[0] / length * float(table[one].sum(dtype=np.float64))
                total += SCALES[1] / length * float(table[two].sum(dtype=np.float64))
            return 1 / (1 + np.exp(-np.clip(total, -35, 35)))

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="float64")

    return scored
