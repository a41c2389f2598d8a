"""Best-fit packing of tokenised documents into sequences of fixed length.

Only the lengths decide how documents fit together, and there are no more lengths than the capacity. So the plan is made on
the histogram of lengths (at most ``capacity`` rows, whatever the data's size): documents above a third of the capacity are
matched, two to a sequence at most, each with the longest partner that fits; shorter ones go where the smallest gap holds
them. Every document then finds its place by its number among the documents of its length.
"""

from __future__ import annotations

import base64
import bisect
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.storage import stored

CAPACITY = 2048
END_OF_TEXT = 0
LONG_RUN = 100_000


def public_encoder():
    """Texts to token ids as little-endian 32-bit numbers, by the public byte-level BPE vocabulary of 50,257 entries. Its
    ranks give the same ids as ``byte_bpe_50k.json``; strings of special tokens count as ordinary text. tiktoken's pattern
    overflows its stack on white space of a million characters, so texts with a run of LONG_RUN are left to tokenizers."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    plain: list[Tokenizer] = []  # loaded by the first text that needs it

    def ids(text: str) -> list[int]:
        if not has_long_run(text):
            return encode(text)
        if not plain:
            plain.append(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
            plain[0].encode_special_tokens = True
        return plain[0].encode(text, add_special_tokens=False).ids

    return lambda text: array("I", ids(text)).tobytes()


def has_long_run(text: str) -> bool:
    """Whether LONG_RUN characters or more of white space follow each other."""
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s+", text))


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: whole ones, and before them what is left over."""
    first = n % capacity
    return [first] * (first > 0) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           make_encoder=public_encoder) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary, little-endian uint32), and the piece's number among
    those of its length in its task (task, at). A null text counts as empty and is its end mark alone. Repeated rows and
    null ids are kept as rows of their own."""
    end = END_OF_TEXT.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task, seen = make_encoder(), TaskContext.get().partitionId(), {}
        for batch in batches:
            out, size = [], 0
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text if isinstance(text, str) else "") + end
                start = 0
                for number, length in enumerate(cut(len(ids) // 4, capacity)):
                    at = seen[length] = seen.get(length, -1) + 1
                    out.append((doc, number, start, length, ids[4 * start:4 * (start + length)], task, at))
                    start += length
                size += len(ids)
                if size > 16_000_000:
                    yield _frame(out)
                    out, size = [], 0
            if out:
                yield _frame(out)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids binary, task int, at long")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "task", "at"])
    if out["doc_id"].isna().any():
        out["doc_id"] = out["doc_id"].astype("Int64") if out["doc_id"].dtype.kind == "f" else out["doc_id"]
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length: (length, first, until, sequence, per, offset) says that the
    pieces numbered from first to until lie per to a sequence, from that sequence on, the first of each at offset.

    Work and result depend on the number of different lengths alone.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    if any(length > capacity or length < 1 for length in left):
        raise ValueError("a piece is longer than a sequence")
    taken = dict.fromkeys(left, 0)
    places: list[tuple[int, int, int, int, int, int]] = []
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
    order: list[int] = []  # the gaps that have sequences, ascending

    def place(length: int, per: int, n: int, sequence: int, offset: int) -> None:
        first = taken[length]
        taken[length] += per * n
        left[length] -= per * n
        places.append((length, first, first + per * n, sequence, per, offset))

    def keep(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((sequence, n))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        if not left[length]:
            large.pop()
            continue
        most = min(length if left[length] > 1 else length - 1, capacity - length)
        at = bisect.bisect_right(large, most) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        if at < 0:
            n, used = left[length], length
            place(length, 1, n, opened, 0)
        elif large[at] == length:
            n, used = left[length] // 2, 2 * length
            place(length, 2, n, opened, 0)
        else:
            other = large[at]
            n, used = min(left[length], left[other]), length + other
            place(length, 1, n, opened, 0)
            place(other, 1, n, opened, length)
        keep(capacity - used, opened, n)
        opened += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                keep(capacity, opened, n := -(-left[length] // (capacity // length)))
                opened += n
                continue
            gap = order[at]
            sequence, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            per = min(gap // length, left[length])
            filled = min(n, left[length] // per)
            place(length, per, filled, sequence, capacity - gap)
            keep(gap - per * length, sequence, filled)
            keep(gap, sequence + filled, n - filled)
    return places


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` (any columns besides) with sequence_id and offset, in place of task and at.

    The rows are stored first, so their numbers stay what they are. The driver sees the histogram of lengths only. What is
    broadcast are the plan's places, whose number the capacity bounds.
    """
    made = stored(made)
    spark = made.sparkSession
    per_task = made.groupBy("task", "length").agg((F.max("at") + 1).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        plan(counts, capacity), "length long, first long, until long, sequence long, per long, offset_0 long")
    before = per_task.select("task", "length", F.coalesce(
        F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    number = F.col("before") + F.col("at") - F.col("first")
    return (
        made.join(before, ["task", "length"])
        .join(F.broadcast(places), "length")
        .filter((F.col("before") + F.col("at") >= F.col("first")) & (F.col("before") + F.col("at") < F.col("until")))
        .withColumn("sequence_id", F.col("sequence") + F.floor(number / F.col("per")).cast("long"))
        .withColumn("offset", F.col("offset_0") + F.pmod(number, F.col("per")) * F.col("length"))
        .select(*[c for c in made.columns if c not in ("task", "at")], "sequence_id", "offset")
    )
