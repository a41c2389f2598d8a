"""Toxicity by compression distance: the same windows of a text, compressed with two zstandard dictionaries.

The one holds the parts of words that set toxic texts apart from ordinary ones, the other those that set ordinary texts
apart, so that a window gets shorter by the first only where it holds what toxic texts hold. A window counts as toxic from a calibrated saving on; a text's score comes from how many do.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.folds import sampled_labels

SAMPLE = 8_000  # labelled rows learned from, at most
FOLDS = 5
WORDS = 8  # words in a window
OWN = 2_000  # letters of a dictionary, at most
GRAM = 5  # letters of the word parts whose texts are counted
OFTEN = 4
LEAST, ODDS = 0.01, 10  # a part tells from that number to a class's texts on, and if it is so much oftener there
STRONG = 0.1  # of the most telling part's weight, for a part to count: what one group of copies repeats has less
STEM = 0.8  # of the number of a word's most frequent telling part, for a part to be joined to it
MATCH = 6  # bytes of the shortest match
MAX_CHARS = 100_000  # of a text that is learned from


#: Starts every window and ends both dictionaries, so zstandard never leaves a window uncompressed.
OPENING = bytes(range(32))


def coded(held: bytes) -> bytes:
    """Two bytes for each three neighbouring letters. A match of MATCH bytes then needs five equal letters, and what no
    dictionary holds costs twice as much as its letters would, so a stem in one of them stands out."""
    b = np.frombuffer(held, dtype=np.uint8).astype(np.uint32)
    mixed = (b[:-2] * np.uint32(40503) + b[1:-1] * np.uint32(30011) * np.uint32(257) + b[2:] * np.uint32(52361) * np.uint32(65599))
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(2654435761)) >> np.uint32(16)).astype("<u2").tobytes()


def windows(text: str) -> list[bytes]:
    """The text, lower-cased and coded, in windows of WORDS words with the blanks around them; words of over 80 bytes are
    cut. A text without a word has none."""
    words = text.lower().encode("utf-8", "replace").split()
    if not words:
        return []
    if max(map(len, words)) > 80:
        words = [w[i:i + 80] for w in words for i in range(0, len(w), 80)]
    whole = coded(b" " + b" ".join(words) + b"  ")
    ends = np.cumsum([0] + [2 + 2 * len(w) for w in words]).tolist()
    cuts = ends[::WORDS] + ends[-1:] * (len(words) % WORDS > 0)
    return [OPENING + whole[a:b] for a, b in zip(cuts, cuts[1:])]


class Sizes:
    """Compressed bytes of a window, with one dictionary."""

    def __init__(self, content: bytes):
        shape = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=MATCH, window_log=17, hash_log=14, chain_log=14, search_log=5,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        prepared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        prepared.precompute_compress(compression_params=shape)
        self._compress = zstandard.ZstdCompressor(dict_data=prepared, compression_params=shape).compress

    def __call__(self, some: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, map(self._compress, some)), dtype=np.int32, count=len(some))


def _grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + GRAM] for i in range(max(1, len(padded) - GRAM + 1))]


def distinct(texts: list[str]) -> list[str]:
    """The texts without those of whose windows a third or more stand in one before: copies would teach many times."""
    seen: set[bytes] = set()
    out = []
    for text in texts:
        some = set(windows(text))
        if 3 * len(some & seen) < len(some) or not some:
            out.append(text)
        seen |= some
    return out


class Texts:
    """The words of a class's texts by fold, and how often each part of GRAM letters stands there, in a text OFTEN times at
    most."""

    def __init__(self, texts: list[str]):
        self.size = [len(texts[k::FOLDS]) for k in range(FOLDS)]
        self.words: list[set[str]] = [set() for _ in range(FOLDS)]
        self.parts: list[Counter] = [Counter() for _ in range(FOLDS)]
        for k, text in enumerate(texts):
            words = Counter(w for w in text.lower().split() if len(w.encode("utf-8", "replace")) <= 80)
            counts: Counter = Counter()
            for w, n in words.items():
                for g in set(_grams(w)):
                    counts[g] += n
            self.words[k % FOLDS].update(words)
            self.parts[k % FOLDS].update({g: min(n, OFTEN) for g, n in counts.items()})

    def without(self, fold: int | None) -> tuple[int, set[str], Counter]:
        """(texts, words, parts) of all folds but one."""
        rest = [k for k in range(FOLDS) if k != fold]
        counts: Counter = Counter()
        for k in rest:
            counts.update(self.parts[k])
        return sum(self.size[k] for k in rest), set().union(*(self.words[k] for k in rest)), counts


def _telling(mine: tuple[int, set[str], Counter], other: tuple[int, set[str], Counter], size: int) -> list[bytes]:
    """Parts of words that set one class's texts apart from the other's, most telling last, in at most ``size`` bytes.

    A part of GRAM letters tells by how much oftener it stands in those texts than in the others, and by how often it
    stands; neighbouring parts of a word that stand about as often are joined, so a stem comes without its endings.
    """
    n, words, counts = mine
    m, _, others = other
    odds = {g: (c + 0.5) / (n + 1) / ((others[g] + 0.5) / (m + 1)) for g, c in counts.items() if c >= max(3, LEAST * n)}
    weight = {g: math.log(x) * math.sqrt(counts[g]) for g, x in odds.items() if x > ODDS}
    least = STRONG * max(weight.values(), default=0)
    odd = {g for g, w in weight.items() if w >= least}
    parts: dict[str, float] = {}
    for word in words:
        grams = _grams(word)
        best = max((counts[g] for g in grams if g in odd), default=0)
        at = [i for i, g in enumerate(grams) if g in odd and counts[g] >= STEM * best]
        while at:
            run = [at.pop(0)]
            while at and at[0] == run[-1] + 1:
                run.append(at.pop(0))
            part = f" {word} "[run[0]:run[-1] + GRAM]
            parts[part] = max(weight[grams[i]] for i in run)
    out, room = [], size
    for part in sorted(parts, key=lambda x: (-parts[x], len(x), x)):
        held = part.encode("utf-8", "replace")
        if len(held) <= room and not any(held in x for x in out):
            out.append(held)
            room -= len(held)
    return out[::-1]


def dictionaries(toxic: Texts, ordinary: Texts, without: int | None = None) -> tuple[bytes, bytes]:
    """Raw dictionary contents for the two classes, of equal length: what tells the class, most telling last."""
    a, b = toxic.without(without), ordinary.without(without)
    return _content(_telling(a, b, OWN)), _content(_telling(b, a, OWN))


def _content(parts: list[bytes]) -> bytes:
    held = b"".join(coded(p) for p in parts if len(p) > 2)
    return held.rjust(2 * OWN, b"\xff")[-2 * OWN:] + OPENING


class Model:
    """Two dictionaries, the saving in bytes from which a window counts, and the weights that make a score of the counts."""

    def __init__(self, toxic: bytes, ordinary: bytes, saving: float, weights: tuple[float, ...]):
        self.toxic, self.ordinary, self.saving, self.weights = toxic, ordinary, saving, weights

    def sizes(self) -> tuple[Sizes, Sizes]:
        return Sizes(self.toxic), Sizes(self.ordinary)


def savings(text: str, sizes: tuple[Sizes, Sizes]) -> np.ndarray:
    some = windows(text)
    return sizes[1](some) - sizes[0](some) if some else np.zeros(0, dtype=np.int32)


def evidence(saved: np.ndarray, saving: float) -> np.ndarray:
    """What the score is made of: a constant; how many windows count and what they save, damped; the number of windows,
    damped; the greatest saving."""
    hits = saved[saved >= saving]
    return np.array([1.0, math.log1p(len(hits)), math.log1p(float(hits.sum())), math.log1p(len(saved)), max(0, int(saved.max(initial=0))) / 8])


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries of all texts; threshold and weights from what each fold's texts save with the other folds' dictionaries.

    Of the thresholds, that one is taken which tells the two classes apart best. With no text of a class every score is
    the other class's, by the constant alone.
    """
    if not toxic or not ordinary:
        return Model(b" ", b" ", 1, (-5.0 if not toxic else 5.0, 0.0, 0.0, 0.0, 0.0))
    toxic, ordinary = distinct(toxic), distinct(ordinary)
    a, b = Texts(toxic), Texts(ordinary)
    saved, labels = [], []
    for fold in range(FOLDS):
        sizes = tuple(map(Sizes, dictionaries(a, b, fold)))
        for texts, label in ((toxic[fold::FOLDS], 1.0), (ordinary[fold::FOLDS], 0.0)):
            saved += [savings(t, sizes) for t in texts]
            labels += [label] * len(texts)
    y = np.array(labels)
    best = None
    for saving in range(1, 13):
        x = np.array([evidence(s, saving) for s in saved])
        w = _logistic(x, y)
        p = np.clip(1 / (1 + np.exp(-x @ w)), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-12:
            best = loss, saving, w
    return Model(*dictionaries(a, b), best[1], tuple(map(float, best[2])))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from a bounded sample of labelled rows (``sample`` rows of up to MAX_CHARS letters from a place picked by a
    hash). Labels other than 0 and 1, null and empty texts teach nothing."""
    picked = sampled_labels(labels, label_col, may_learn, sample)
    spare = F.greatest(F.length("text") - MAX_CHARS, F.lit(0))
    start = F.pmod(F.xxhash64("doc_id"), spare + 1) + 1
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").filter("trim(text) <> ''")
        .select(F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "label", F.substr("text", start.cast("int"), F.lit(MAX_CHARS)).alias("text"))
    )
    fitted = rows.groupBy(F.lit(0).alias("all")).applyInPandas(
        _fit_rows, "toxic binary, ordinary binary, saving double, weights array<double>").collect()
    if not fitted:
        return fit([], [])
    got = fitted[0]
    return Model(bytes(got["toxic"]), bytes(got["ordinary"]), got["saving"], tuple(got["weights"]))


def _fit_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["h", "label", "text"])
    m = fit(rows["text"][rows["label"] == 1].tolist(), rows["text"][rows["label"] == 0].tolist())
    return pd.DataFrame({"toxic": [m.toxic], "ordinary": [m.ordinary], "saving": [float(m.saving)], "weights": [list(m.weights)]})


def score(model: Model, spark) -> callable:
    """A column function: the probability of label 1 for whole texts. Null counts as empty, which holds no toxic window."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        sizes, weights = m.sizes(), np.array(m.weights)

        def one(text) -> float:
            x = evidence(savings(text if isinstance(text, str) else "", sizes), m.saving)
            return float(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="float64")

    return scored
