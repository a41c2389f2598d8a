"""Vector codes by product quantisation, with Orchard's search for the nearest entry.

Every codebook entry has the list of all entries by their distance from it. A search holds one entry; it reads that
entry's list, and where an entry on it is nearer to the point, goes on with that one's list. Entries that were measured are
marked. An entry nearer than the held one can lie no further from it than twice the point's distance, so there the list
may be left, and the held entry is the nearest. All rows of a batch walk at once, each its own way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.llm.storage import stored
from silverloom.sources.tables import spread_lookup

AT_ONCE = 8_192  # rows that walk together


class Codebook:
    """Entries of one part with their lists; whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.far = np.take_along_axis(apart, self.near, axis=1)
        self.by_first = np.argsort(entries[:, 0], kind="stable")

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry, the lower index of equally near ones."""
        n, k = len(points), len(self.entries)
        place = np.searchsorted(self.entries[self.by_first, 0], points[:, 0])
        held = self.by_first[np.minimum(place, k - 1)]
        away = ((points - self.entries[held]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[np.arange(n), held] = True
        at = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        while len(walking):
            mine, step = held[walking], at[walking]
            # twice the distance is four times the square; entries at just that distance may tie
            on = self.far[mine, step] <= 4 * away[walking]
            walking, mine, step = walking[on], mine[on], step[on]
            other = self.near[mine, step]
            at[walking] = step + 1
            new = ~seen[walking, other]
            rows, other = walking[new], other[new]
            seen[rows, other] = True
            d = ((points[rows] - self.entries[other]) ** 2).sum(axis=1)
            better = (d < away[rows]) | ((d == away[rows]) & (other < held[rows]))
            rows = rows[better]
            held[rows], away[rows], at[rows] = other[better], d[better], 0
            walking = walking[at[walking] < k]
        return held, away


class Codebooks:
    """One codebook for each part of a vector."""

    def __init__(self, entries: np.ndarray):
        """Whole numbers by part, entry and position."""
        self.entries = entries
        self.parts = [Codebook(part) for part in entries]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes by row and part, squared distances likewise)."""
        cut = vectors.reshape(len(vectors), len(self.parts), -1)
        found = [book.nearest(cut[:, p]) for p, book in enumerate(self.parts)]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def finite(vector: Column) -> Column:
    """Not null, no component null or non-finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _whole(vectors: pd.Series, scale: int) -> np.ndarray:
    return np.floor(np.array(vectors.tolist(), dtype=np.float64) * scale).astype(np.int64)


def _start(rows: DataFrame, size: int, width: int, parts: int, scale: int) -> np.ndarray:
    """The vectors of the smallest ids, by part, entry and position. Ids are looked for first, so that vectors are only read
    of those rows."""
    order = F.col("id").asc_nulls_last()
    ids = [r["id"] for r in rows.select("id").orderBy(order).limit(size).collect()]
    if ids and ids[-1] is not None:
        rows = rows.filter(F.col("id") <= F.lit(ids[-1]))
    first = rows.orderBy(order, "vector").limit(size).select("vector").toPandas()["vector"]
    return _whole(first, scale).reshape(len(first), parts, width // parts).transpose(1, 0, 2)


def _moved(rows: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """Each entry replaced by the mean, rounded down, of the parts that are nearest to it. A task passes on one sum for each
    number of the codebooks, however many rows it has read."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    n_parts, size, part_width = books.entries.shape

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_parts, size, part_width), dtype=object)
        count = np.zeros((n_parts, size), dtype=np.int64)
        for batch in batches:
            for k in range(0, len(batch), AT_ONCE):
                whole = _whole(batch["vector"].iloc[k:k + AT_ONCE], scale)
                codes, _ = shared.value.encode(whole)
                cut = whole.reshape(len(whole), n_parts, part_width)
                part = np.zeros((n_parts, size, part_width), dtype=np.int64)
                for p in range(n_parts):
                    np.add.at(part[p], codes[:, p], cut[:, p])
                    count[p] += np.bincount(codes[:, p], minlength=size)
                total += part
        p, e, w = (x.ravel() for x in np.meshgrid(*map(range, total.shape), indexing="ij"))
        n = count[p, e]
        keep = n > 0
        yield pd.DataFrame({"part": p[keep], "entry": e[keep], "at": w[keep], "total": pd.Series([str(t) for t in total.ravel()[keep]], dtype=object), "n": n[keep]})

    made = (
        rows.select("vector").mapInPandas(sums, "part int, entry int, at int, total string, n long")
        .groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    entries = books.entries.copy()
    for r in made:
        entries[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def train(rows: DataFrame, width: int, parts: int, size: int, rounds: int, scale: int) -> Codebooks:
    """Codebooks of the rows (id, vector), all of ``width`` components; every row counts."""
    books = Codebooks(_start(rows, size, width, parts, scale))
    for _ in range(rounds):
        books = _moved(rows, books, scale)
    return books


def encode(vectors: DataFrame, parts: int = 16, size: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row whose vector is not null and has only finite components.

    Components become whole numbers, ``floor(scale * x)``. Codebooks start from the parts of the ``size`` smallest ids (null
    ids last, equal ids by their vectors; fewer rows, fewer entries) and move ``rounds`` times to the means of their rows.
    ``error`` is the squared distance between a vector and its code, ``label_error`` its sum over the rows of equal label,
    nulls together. Repeated rows count each.

    Codebooks fit one width, that of the smallest id whose vector can be cut into equal parts. Vectors of another width
    have a null code and error and take no part, and so have those with a number so large that an error may not fit a long
    (beyond 2^19 at 64 components and a scale of 256). Where no row takes part, no codebooks exist: their digest is that of
    the empty text. A label of which no row takes part has a null ``label_error``, and so has one whose sum a long can't hold.
    """
    vector = F.col("vector")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    rows = rows.filter(finite(vector))
    fits = rows.filter((F.size(vector) > 0) & (F.size(vector) % parts == 0))
    least = fits.select(F.col("id"), F.size(vector).alias("width")).orderBy(F.col("id").asc_nulls_last(), "width").limit(1).collect()
    width = least[0]["width"] if least else 0
    # (2 * reach)^2 * width stays below 2^63
    reach = isqrt(2 ** 60 // max(width, 1))
    usable = (F.size(vector) == width) & F.lit(width > 0) & F.forall(vector, lambda x: F.abs(x * scale) < reach)
    taken = rows.filter(usable)
    books = train(taken, width, parts, size, rounds, scale) if width and not taken.isEmpty() else Codebooks(np.zeros((0, 0, 0), dtype=np.int64))
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("code string, error long")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = np.full(len(batch), None, dtype=object)
            errors = pd.array([pd.NA] * len(batch), dtype="Int64")
            places = np.flatnonzero(batch.notna())
            for k in range(0, len(places), AT_ONCE):
                some = places[k:k + AT_ONCE]
                found, away = shared.value.encode(_whole(batch.iloc[some], scale))
                codes[some] = [row.tobytes().hex() for row in found.astype(np.uint8)]
                errors[some] = away.sum(axis=1)
            yield pd.DataFrame({"code": codes, "error": errors})

    out = rows.select("id", "label", coded(F.when(usable, vector)).alias("c"))
    # labels as text with a sign for null, so that nulls meet as well
    out = stored(out.select("id", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("of"), "c.code", "c.error"))
    sums = out.groupBy("of").agg(F.try_sum("error").alias("label_error"))
    return spread_lookup(out, sums, ["of"]).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
