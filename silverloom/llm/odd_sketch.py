"""Near duplicates by MinHash bands, odd sketches and full sets of word shingles.

Equal sets are one class from the start. Documents whose MinHash bands meet are candidates; their odd sketches (the
samples folded into a parity bitmap, whose differing bits estimate how many samples differ) settle which are compared in
full. First every band group's members are compared with its smallest document, their centre. What these links leave apart,
the strays, is then compared with all other members of its centres, by what their sets differ in from the centre's. So the
components are those of all pairs, though a group of many copies never spells out its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.components import components
from silverloom.llm.storage import stored

BANDS, ROWS = 25, 5
SKETCH_BITS = 1024
SLACK = 0.12  # a sketch may underestimate by this much; about four standard deviations at 0.85
BLOCK = 1_000  # strays that one task compares with as many members of their groups
CACHED_WORDS = 300_000

SAMPLES = BANDS * ROWS
_seeds = np.random.default_rng(41)
_factor = _seeds.integers(1, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_add = _seeds.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_bit_factor = _seeds.integers(1, 2**63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_band_factor = _seeds.integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> bytes:
        held = xxhash.xxh3_64_digest(word)
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = held
        return held


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; of fewer words the whole sequence is one. A-Z count as
    a-z; words are parted by ASCII white space."""
    if not isinstance(text, str):
        return np.zeros(0, dtype=np.uint64)
    one = np.frombuffer(b"".join(map(words.__getitem__, text.encode("utf-8", "replace").lower().split())), dtype=">u8").astype(np.uint64)
    if not len(one):
        return one
    width = min(size, len(one))
    out = np.zeros(len(one) - width + 1, dtype=np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + one[k:len(one) - width + 1 + k] + np.uint64(k + 1))
    return np.unique(out)


def signature(sets: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(band keys, odd sketch) of a set that is not empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(sets), 2048):
        hashed = sets[at:at + 2048, None] * _factor[None, :] + _add[None, :]
        hashed ^= hashed >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0), out=least)
    bands = _mixed((least.reshape(BANDS, ROWS) * _band_factor).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    bits = (_mixed(least * _bit_factor) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(bits, minlength=SKETCH_BITS) & 1
    return bands.view(np.int64), np.packbits(odd.astype(np.uint8)).tobytes()


def most_differing(similarity: float) -> int:
    """Differing bits of two odd sketches up to which the pair may be that similar: the expected number at ``similarity``
    less SLACK."""
    apart = 2 * SAMPLES * (1 - max(0.0, similarity - SLACK))
    return int(np.ceil(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** apart)))


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, same, bands, sketch) of every row; ``same`` is equal for equal sets, null for empty ones."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                sets = [shingles(t, size, words) for t in part["text"]]
                made = [signature(s) if len(s) else (None, None) for s in sets]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "n_shingles": [len(s) for s in sets],
                    "same": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "bands": [b for b, _ in made], "sketch": [s for _, s in made]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    return rows.mapInPandas(run, "doc_id long, n_shingles long, same binary, bands array<long>, sketch binary")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= percent * union holds on the full sets, made anew from the texts."""
    texts = docs.select(F.col("doc_id").alias("a"), "text")
    both = (
        pairs.join(texts.withColumnRenamed("text", "text_a"), "a")
        .join(texts.select(F.col("a").alias("b"), F.col("text").alias("text_b")), "b")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            keep, last, mine = [], None, None
            for a, x, y in zip(batch["a"], batch["text_a"], batch["text_b"]):
                if a != last:
                    last, mine = a, shingles(x, size, words)
                other = shingles(y, size, words)
                shared = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(mine) + len(other) - shared))
            yield batch.loc[keep, ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _differing(x: str, y: str) -> F.Column:
    """Bits in which two sketches of eight-byte words differ."""
    words = SKETCH_BITS // 64
    part = lambda c, k: F.conv(F.hex(F.substring(F.col(c), 8 * k + 1, 8)), 16, -10).cast("long")
    return sum((F.bit_count(part(x, k).bitwiseXOR(part(y, k))) for k in range(words)), F.lit(0))


def _differences(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, doc_id, n, diff): of each pair the size of the document's set, and in what it differs from its centre's."""
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select("doc_id", "text"), "doc_id")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200]
                own = [shingles(t, size, words) for t in part["text"]]
                diff = [np.setxor1d(x, shingles(t, size, words), assume_unique=True) for x, t in zip(own, part["text_a"])]
                yield pd.DataFrame({
                    "a": part["a"].to_numpy(), "doc_id": part["doc_id"].to_numpy(), "n": [len(x) for x in own],
                    "diff": [d.astype("<u8").tobytes() for d in diff]})

    return both.mapInPandas(run, "a long, doc_id long, n long, diff binary")


def _across(members: DataFrame, most: int, percent: int) -> DataFrame:
    """Links (a, b) between a centre's strays and its members in other components, as many as tie the components together.

    ``members``: centre, stray, doc_id, component, sketch, n, diff. Strays and members are cut into blocks, and one task
    compares a block of strays with a block of members: where the sketches allow a link, the differences from the centre
    say exactly how much two sets share.
    """
    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)).select(F.expr("centre | 0L").alias("centre"), name)

    blocks = counted(members.filter("stray"), "n_left").join(counted(members, "n_right"), "centre").select(F.expr("centre | 0L").alias("centre"), "n_left", "n_right")
    placed = members.join(blocks, "centre")
    own = lambda n: F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    rest = ["doc_id", "component", "sketch", "n", "diff"]
    left = placed.filter("stray").select("centre", own("n_left").alias("i"), each("n_right").alias("j"), F.lit(True).alias("left"), *rest)
    right = placed.select("centre", each("n_left").alias("i"), own("n_right").alias("j"), F.lit(False).alias("left"), *rest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, ["centre", "i", "j"]):
            is_left = group["left"].to_numpy(dtype=bool)
            if is_left.any() and not is_left.all():
                yield _ties(group[is_left], group[~is_left], most, percent)

    # rows of a group lie together after the sort, so a task holds one block of each kind at a time
    return (
        left.unionByName(right).repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j")
        .mapInPandas(run, "a long, b long").distinct()
    )


def _ties(left: pd.DataFrame, right: pd.DataFrame, most: int, percent: int) -> pd.DataFrame:
    """Of two blocks, links between components: for each of left one to every component it meets, unless they are tied."""
    bits = lambda rows: np.unpackbits(np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
    x, y = bits(left), bits(right)
    apart = x.sum(axis=1)[:, None] + y.sum(axis=1)[None, :] - 2 * (x @ y.T)
    mine, theirs = left["component"].to_numpy(), right["component"].to_numpy()
    near = (apart <= most) & (mine[:, None] != theirs[None, :])
    diffs = [np.frombuffer(d, dtype="<u8") for d in right["diff"]]
    sizes = np.array([len(d) for d in diffs])
    n, ids, out = right["n"].to_numpy(), right["doc_id"].to_numpy(), []
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    for k, (doc, own, n_own, held) in enumerate(zip(left["doc_id"], mine, left["n"], left["diff"])):
        at = np.flatnonzero(near[k])
        at = at[[find(int(theirs[m])) != find(int(own)) for m in at]] if len(at) else at
        if not len(at):
            continue
        diff = np.frombuffer(held, dtype="<u8")
        both = np.concatenate([diffs[m] for m in at])
        shared = np.zeros(len(both), dtype=np.int64)
        if len(diff) and len(both):
            place = np.minimum(np.searchsorted(diff, both), len(diff) - 1)
            shared = (diff[place] == both).astype(np.int64)
        ends = np.cumsum(sizes[at])
        sums = np.concatenate(([0], np.cumsum(shared)))
        common = sums[ends] - sums[ends - sizes[at]]
        differ = len(diff) + sizes[at] - 2 * common
        inside = (n_own + n[at] - differ) // 2
        for m in at[100 * inside >= percent * (n_own + n[at] - inside)]:
            a, b = find(int(own)), find(int(theirs[m]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((min(doc, ids[m]), max(doc, ids[m])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The consecutive groups of sorted batches, each whole."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = (batch[keys].to_numpy()[1:] != batch[keys].to_numpy()[:-1]).any(axis=1)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.iloc[a:b]
            if held and tuple(held[0][keys].iloc[0]) != tuple(part[keys].iloc[0]):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row with an id.

    Rows link where their sets of ``size``-word shingles share ``percent`` hundredths of their union. ``component_id`` is
    the smallest id reachable by links, the row's own included; empty sets (null or empty texts) link with nothing. Rows
    that repeat an id are all kept (an id that repeats should repeat its text); null ids are dropped, as they name no
    document. Ids are whole numbers.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    signed = stored(signatures(texts, size))
    classes = stored(
        signed.filter("same IS NOT NULL").groupBy("same").agg(F.min(F.struct("doc_id", "bands", "sketch")).alias("m"))
        .select("same", "m.doc_id", "m.bands", "m.sketch"))
    found = _class_components(classes, texts, size, percent)
    of_class = classes.select("same", "doc_id").join(found.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").select(
        F.expr("concat(same, X'')").alias("same"), F.coalesce("component", "doc_id").alias("component"))
    return (
        signed.select("doc_id", "n_shingles", "same").join(of_class, "same", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )


def _class_components(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, component) of the classes that have links; components as all confirmed candidate pairs give them."""
    most = most_differing(percent / 100)
    banded = classes.select("doc_id", F.explode("bands").alias("key"))
    least = banded.groupBy("key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    grouped = stored(banded.join(least.select(F.expr("key ^ 0L").alias("key"), "a", "n"), "key"))
    ids = grouped.select("doc_id").distinct()
    texts = stored(texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    sketches = classes.select("doc_id", "sketch")
    stars = stored(grouped.filter("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct())
    pairs = (
        stars.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a")
        .join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
        .filter(_differing("x", "y") <= most).select("a", "b")
    )
    links = stored(confirmed(pairs, texts, size, percent))
    found = stored(components(links))
    # a stray is not in the component of the smallest document of its group, which is its centre here. Two members of a
    # group in different components are a stray and another, so comparing each centre's strays with all its members is
    # enough, and then nothing is left to compare
    label = lambda name, to: found.select(F.col("id").alias(name), F.col("component").alias(to))
    placed = (
        stars.join(label("b", "component"), "b", "left").join(label("a", "main"), "a", "left")
        .select("a", F.col("b").alias("doc_id"), F.coalesce("component", "b").alias("component"), F.coalesce("main", "a").alias("main"))
        .withColumn("stray", F.col("component") != F.col("main"))
    )
    placed = stored(placed)
    centres = placed.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.max("stray").alias("any"), F.min("main").alias("main")).filter("n > 1 AND any")
    centres = stored(centres.select(F.expr("a | 0L").alias("a"), "main"))
    if centres.isEmpty():
        return found
    wanted = placed.join(centres.select("a"), "a", "left_semi").select("a", "doc_id", "component", "stray").unionByName(
        centres.select("a", F.col("a").alias("doc_id"), F.col("main").alias("component"), F.lit(False).alias("stray")))
    held = _differences(wanted.select("a", "doc_id"), texts, size)
    members = stored(
        wanted.join(held, ["a", "doc_id"]).join(sketches, "doc_id").withColumnRenamed("a", "centre")
        .select("centre", "stray", "doc_id", "component", "sketch", "n", "diff"))
    return components(links.unionByName(_across(members, most, percent)))
