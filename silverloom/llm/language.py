"""Language identification by compression: the language whose zstandard dictionary makes a text smallest.

Each language has a raw-content dictionary, cut from a bounded sample of its texts. The sample's labels may be wrong: each
half is first read with dictionaries of the other half, and texts that another language fits better are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 600  # texts of a language learned from, at most
SAMPLE_CHARS = 2_000  # of each, from a place picked by a hash
DICTIONARY = 48_000  # bytes
WINDOW = 2_000  # bytes compressed at once
SHORT = 600  # bytes below which a text is spelled out
#: A margin below this share of the smallest size is too narrow. Held-out texts of learned languages lie above (of 1,464 of
#: 100 bytes and more, 99.5 in a hundred have 0.045), texts of a language that was not learned mostly below (median 0.004).
NARROW = 0.02
UNDETERMINED = "und"
#: Starts every window and ends every dictionary, so zstandard never leaves a short text uncompressed.
OPENING = bytes(range(32))

_spelling = np.random.default_rng(11).integers(0, 256, (256, 2), dtype=np.uint8)


class _Sizes:
    """Compressed bytes of texts, with one dictionary."""

    def __init__(self, content: bytes, least: int):
        shape = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=least, window_log=17, hash_log=15, chain_log=15, search_log=3,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        prepared = zstandard.ZstdCompressionDict(content + OPENING, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        prepared.precompute_compress(compression_params=shape)
        self._compress = zstandard.ZstdCompressor(dict_data=prepared, compression_params=shape).compress

    def __call__(self, held: bytes) -> int:
        return sum(len(self._compress(OPENING + held[i:i + WINDOW])) for i in range(0, len(held), WINDOW))


class Reader:
    """The language of a text, by the sizes it has with each language's dictionary.

    In texts of fewer than SHORT bytes every byte is spelled with two, in the dictionaries too: a word the dictionary holds
    then saves more than a match costs.
    """

    def __init__(self, contents: dict[str, bytes]):
        self.names = sorted(contents)
        self._long = [_Sizes(contents[n], 4) for n in self.names]
        self._short = [_Sizes(_spelled(contents[n]), 6) for n in self.names]

    def sizes(self, text: str) -> list[int]:
        held = text.lower().encode("utf-8", "replace")
        if len(held) < SHORT:
            return [size(_spelled(b" " + held + b" ")) for size in self._short]
        return [size(held) for size in self._long]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin). The margin is what the next language's size is above the smallest, as a share of it;
        the score is one half where it is NARROW. Equal sizes go to the first name, with a margin and a score of 0."""
        if not isinstance(text, str) or not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(text)
        if len(sizes) == 1:
            return self.names[0], 1.0, 1.0
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        margin = sizes[order[1]] / sizes[order[0]] - 1
        return self.names[order[0]], 1 - 2.0 ** (-margin / NARROW), margin


def _spelled(held: bytes) -> bytes:
    return _spelling[np.frombuffer(held, dtype=np.uint8)].tobytes()


def _content(texts: list[str]) -> bytes:
    """A dictionary of all texts: each gives as many bytes as fit if all give alike; what short ones leave, longer ones take."""
    held = [t.lower().encode("utf-8", "replace") for t in texts]
    room, lengths = DICTIONARY - len(held), sorted(map(len, held))
    each = 0
    for k, length in enumerate(lengths):
        each = room // (len(lengths) - k)
        if length > each:
            break
        room, each = room - length, length
    return b" ".join(h[:each] for h in held)


def learn(sample: list[tuple[str, str]]) -> dict[str, bytes]:
    """Dictionary contents by language, from (language, text) rows."""
    by = defaultdict(list)
    for lang, text in sample:
        by[lang].append(text)
    halves = [{lang: texts[k::2] or texts for lang, texts in by.items()} for k in (0, 1)]
    kept = defaultdict(list)
    for own, other in (halves, halves[::-1]):
        read = Reader({lang: _content(texts) for lang, texts in other.items()})
        for lang, texts in own.items():
            kept[lang] += [t for t in texts if read(t)[0] == lang]
    return {lang: _content(kept[lang] or texts) for lang, texts in by.items()}


def _hash_limit(wanted: int, rows: int) -> int:
    """A 64-bit hash that at least ``wanted`` of that many rows stay below, but for odds of one in 10^15."""
    return min(2 ** 63 - 1, int((wanted + 8 * wanted ** 0.5 + 64) / rows * 2 ** 64) - 2 ** 63)


def train(docs: DataFrame, may_learn: Column, sample: int = SAMPLE) -> dict[str, bytes]:
    """Dictionary contents, from at most ``sample`` texts of each language of the rows that may be learned from.

    Ids are picked first, so only the texts of the sample move: the rows of each language are counted, and of those only
    rows with a hash below the share that is wanted are ranked, as many as there are languages times a little more than
    ``sample``, whatever the table's size. Null languages and null or empty texts teach nothing; no row to learn from gives
    no language, and every text is then undetermined.
    """
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(17))
    rows = docs.filter(may_learn & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", hashed.alias("h"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # as many as the model has dictionaries
    if not counts:
        return {}
    limits = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], _hash_limit(sample, r["n"]))])
    ids = (
        rows.filter(F.col("h") <= F.try_element_at(limits, F.col("lang"))).distinct()
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).filter(F.col("n") <= sample)
        .select("doc_id", "lang")
    )
    start = F.pmod(hashed, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    rows = (
        docs.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])  # sample x languages rows
        .select("doc_id", "lang", hashed.alias("h"), F.substr("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
        .groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text")).collect()  # an id that repeats gives one text
    )
    return learn([(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["h"], r["lang"], r["text"]))])


def identify(contents: dict[str, bytes], spark) -> callable:
    """A column function of whole texts: (lang_pred, score, margin). Null texts and texts without a letter are
    undetermined, with score and margin 0."""
    shared = spark.sparkContext.broadcast(contents)

    @F.pandas_udf("lang_pred string, score double, margin double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        read = Reader(shared.value)
        for batch in batches:
            yield pd.DataFrame([read(t) for t in batch], columns=["lang_pred", "score", "margin"])

    return identified


def is_sure(margin: Column, lang: Column, narrow: float = NARROW) -> Column:
    """Whether a prediction stands: undetermined texts and narrow margins are rejected."""
    return (lang != UNDETERMINED) & (margin >= narrow)
