"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference points in order, the best of which name the inverted lists it is filed
under. Two vectors that meet in a list and share enough of their reference points are candidates; cosines in double
precision decide. Equal vectors are one class from the start. A list is worked through block by block, and what leaves a
task are counts and a spanning star of each local component, so a dense list never spells out its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.components import components
from silverloom.llm.storage import stored

PER_PIVOT = 50  # classes to a reference point
MIN_PIVOTS, MAX_PIVOTS = 32, 8_192  # the upper bound holds what is sent to every task at 8192 vectors
APART = 0.8  # cosine below which two reference points stay
NEAREST = 8  # reference points that describe a vector
LISTS = 4  # of them, whose lists hold it
SHARED = 2  # that a candidate pair has in common at least
BLOCK = 500  # vectors of a list that one task compares with as many others


def usable(vector: Column) -> Column:
    """Whether a vector can have a cosine: not null, not empty, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(held: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(held), dtype="<f8").reshape(len(held), width)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so very large or small components do not overflow when squared
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Reference points by dimension: a hash-picked sample of the classes, one to PER_PIVOT of them within the bounds, of
    which no two are close."""
    counts = {r["width"]: r["n"] for r in classes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for width, n in counts.items():
        take = min(max(-(-n // PER_PIVOT), MIN_PIVOTS), MAX_PIVOTS)
        picked = classes.filter(F.col("width") == width).orderBy(F.xxhash64("vector", F.lit(13)), "cid").limit(take).select("vector").collect()
        out[width] = _spread(_unit(np.array([r["vector"] for r in picked], dtype=np.float64)))
    return out


def _spread(points: np.ndarray) -> np.ndarray:
    """The points without those close to an earlier one: several in one dense group would tell its members apart by chance."""
    keep = [0]
    for k in range(1, len(points)):
        if (points[keep] @ points[k]).max() < APART:
            keep.append(k)
    return points[keep]


def _filed(classes: DataFrame, reference: dict[int, np.ndarray]) -> DataFrame:
    """(width, pivot, cid, n, near, unit): a row for each list that a class is filed under."""
    shared = classes.sparkSession.sparkContext.broadcast(reference)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, rows in batch.groupby("width"):
                points = shared.value[width]
                for at in range(0, len(rows), 500):
                    part = rows.iloc[at:at + 500]
                    unit = _unit(np.array(part["vector"].tolist(), dtype=np.float64))
                    near = np.argsort(-(unit @ points.T), axis=1, kind="stable")[:, :NEAREST].astype("<i4")
                    lists = near[:, :LISTS]
                    reps = np.repeat(np.arange(len(part)), lists.shape[1])
                    yield pd.DataFrame({
                        "width": width, "pivot": lists.ravel(), "cid": part["cid"].to_numpy()[reps], "n": part["n"].to_numpy()[reps],
                        "near": [near[k].tobytes() for k in reps], "unit": [unit[k].astype("<f8").tobytes() for k in reps]})

    return classes.select("width", "cid", "n", "vector").mapInPandas(
        run, "width int, pivot int, cid long, n long, near binary, unit binary")


def _compare(rows: pd.DataFrame, least_cosine: float) -> pd.DataFrame:
    """Counts and star edges of two blocks of a list: (cid, links, other)."""
    pivot, width, i, j = (int(rows[c].iloc[0]) for c in ("pivot", "width", "i", "j"))
    rows = rows.sort_values("cid")
    left = rows[rows["block"] == i]
    right = left if i == j else rows[rows["block"] == j]
    if left.empty or right.empty:
        return pd.DataFrame({"cid": [], "links": [], "other": []}).astype("int64")
    near = [np.array([np.frombuffer(b, dtype="<i4") for b in side["near"]]) for side in (left, right)]
    known, places = np.unique(np.concatenate([x.ravel() for x in near]), return_inverse=True)
    marks = []
    for x, at in zip(near, np.split(places, [near[0].size])):
        one = np.zeros((len(x), len(known)), dtype=np.float32)
        one[np.repeat(np.arange(len(x)), x.shape[1]), at] = 1
        listed = np.zeros_like(one)
        first = at.reshape(x.shape)[:, :LISTS]
        listed[np.repeat(np.arange(len(x)), first.shape[1]), first.ravel()] = 1
        marks.append((one, listed[:, known < pivot]))
    shared = marks[0][0] @ marks[1][0].T
    earlier = marks[0][1] @ marks[1][1].T  # a pair belongs to the first list that holds both
    close = _matrix(left["unit"], width) @ _matrix(right["unit"], width).T >= least_cosine
    link = close & (shared >= min(SHARED, near[0].shape[1])) & (earlier == 0)
    if i == j:
        np.fill_diagonal(link, False)
    a, b = left["cid"].to_numpy(), right["cid"].to_numpy()
    out = [pd.DataFrame({"cid": a, "links": link @ right["n"].to_numpy(), "other": _stars(a, b, link)})]
    if i != j:
        out.append(pd.DataFrame({"cid": b, "links": link.T @ left["n"].to_numpy(), "other": _stars(b, a, link.T)}))
    made = pd.concat(out)
    return made[made["links"] > 0]


def _stars(a: np.ndarray, b: np.ndarray, link: np.ndarray) -> np.ndarray:
    """For each of a, the smallest id it is tied to through chains of links in the block."""
    label_a, label_b = a.copy(), b.copy()
    while True:
        big = np.iinfo(np.int64).max
        next_b = np.minimum(label_b, np.where(link, label_a[:, None], big).min(axis=0))
        next_a = np.minimum(label_a, np.where(link, next_b[None, :], big).min(axis=1))
        if (next_a == label_a).all() and (next_b == label_b).all():
            return label_a
        label_a, label_b = next_a, next_b


def near_vectors(vectors: DataFrame, least_cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows whose cosine with this one is at least ``least_cosine``, as far as the index finds
    them; ``component_id`` is the smallest id reachable by links. Null and zero vectors, and those with null or
    non-finite components, have no links and are their own component; vectors of different lengths do not link. Rows that
    repeat a vector link with each other. An id that repeats should repeat its vector.
    """
    vector = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("ok", usable(vector))
    # 0.0 and -0.0 are equal
    plain = F.transform(vector, lambda x: x + F.lit(0.0))
    good = rows.filter("ok").select("vec_id", plain.alias("vector"))
    classes = stored(
        good.groupBy("vector").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("n")).withColumn("width", F.size("vector")))
    filed = stored(_filed(classes, pivots(classes)))
    sizes = filed.groupBy("width", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    spread = (
        # a row for each list, so no more than there are reference points
        filed.join(F.broadcast(sizes), ["width", "pivot"])
        .withColumn("block", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("width", "pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "n", "near", "unit")
    )
    found = stored(
        spread.groupBy("width", "pivot", "i", "j")
        .applyInPandas(lambda rows: _compare(rows, least_cosine), "cid long, links long, other long"))
    reached = components(found.select(F.col("cid").alias("a"), F.col("other").alias("b")))
    of_class = (
        classes.join(found.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
        .join(reached.select(F.col("id").alias("cid"), "component"), "cid", "left")
        .select(F.concat("vector", F.array().cast("array<double>")).alias("vector"),
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "cid").alias("component"))
    )
    return (
        rows.select("vec_id", F.when(F.col("ok"), plain).alias("vector")).join(of_class, "vector", "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
