"""The operators over the given tables, with production parameters, and the SQL of those that SQL can say."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm import (
    decontamination, hamming, html_model, language, mixing, odd_sketch, packing, pivot_index, quality, spelling, toxicity,
    url_rules, vector_codes)
from silverloom.llm.folds import remainder
from silverloom.llm.storage import stored
from silverloom.sources.tables import load

HELD_OUT = {"lang": (3, 1), "toxic": (3, 1), "quality": (5, 0)}  # crc32 of the id by the first is the second: not learned from


def held_out(name: str) -> Column:
    folds, at = HELD_OUT[name]
    return remainder("doc_id", folds) == at


def op1_pivot_permutation(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_index.near_vectors(load(spark, folder, "embeddings"))


def op2_compression_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    read = language.identify(language.train(docs, ~held_out("lang")), spark)
    return docs.select("doc_id", held_out("lang").alias("held_out"), read("text").alias("r")).select(
        "doc_id", "held_out", "r.lang_pred", "r.score", "r.margin")


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    sites = [r.name for r in url_rules.SITE_RULES]
    judged = url_rules.judge(load(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", F.when(F.col("fits").isin(sites), F.col("fits")).alias("rule"), "verdict")


def domain(source: Column) -> Column:
    """The first level of the tree: what kind of source it is, by its number."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    number = F.when(number != "", number).cast("int")
    return F.when(number == 0, "crawl").when(number < 10, "forum").when(number >= 10, "library")


MIX_WEIGHTS = {
    ("crawl",): 0.5, ("forum",): 0.15, ("library",): 0.35,
    **{(d, lang): w for d in ("crawl", "forum", "library") for lang, w in (("en", 0.55), ("de", 0.15), ("fr", 0.15), ("es", 0.15))},
}


def op4_hierarchical_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    counted = stored(docs.select("doc_id", "lang", "source", mixing.word_count(F.col("text")).alias("n_tokens")))
    mixed = mixing.mix(counted, [domain(F.col("source")), F.col("lang"), F.col("source")], F.col("n_tokens"), MIX_WEIGHTS, 0.6, max_epochs=3, seed=1)
    return mixed.select("_row.doc_id", F.col("_leaf").alias("leaf"), F.col("_tokens").alias("n_tokens"), F.col("_epoch").alias("epoch"), F.col("_taken").alias("taken"))


def op5_html_tree_model(spark: SparkSession, folder: str) -> DataFrame:
    return html_model.extract_text(load(spark, folder, "pages"), html_model.train()).withColumn("n_chars", F.length("text").cast("long"))


def op6_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.near_duplicates(load(spark, folder, "documents"), size=3, percent=85)


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    made = packing.pieces(load(spark, folder, "documents"))
    return packing.pack(made.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32"))


SEARCH_BITS, SEARCH_K = 32, 10


def op8_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(load(spark, folder, "embeddings").select("vec_id", hamming.sign_code(F.col("embedding"), SEARCH_BITS).alias("code")))
    queries = rows.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "code")
    return hamming.top_k(rows, queries, SEARCH_K, SEARCH_BITS)


def op9_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    score = toxicity.score(toxicity.train(docs, load(spark, folder, "labels"), ~held_out("toxic")), spark)
    return (
        docs.select("doc_id", held_out("toxic").alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op10_ftrl_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    score = quality.score(quality.train(docs, load(spark, folder, "labels"), ~held_out("quality")), spark)
    return (
        docs.select("doc_id", held_out("quality").alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.3).cast("int")))


def op11_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find(load(spark, folder, "documents").select("doc_id", "text"), load(spark, folder, "benchmark"), 10)
    hit = decontamination.hit_words(F.col("found"))
    return (
        found.select("doc_id", "found.n_words", hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
                     F.sha2(F.concat_ws(",", "found.items").cast("binary"), 256).alias("items_sha256"))
        .withColumn("contaminated", F.col("n_hit") > 0))


def letter_dropped(doc: str, run: bytes) -> bytes:
    """The run, or without one letter where 31 divides the crc32 of id and run."""
    h = zlib.crc32(f"{doc}:{run.decode('latin-1')}".encode())
    at = h % len(run)
    return run if h % 31 else run[:at] + run[at + 1:]


def op12_permuterm_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.count_words(load(spark, folder, "documents"), 7, 2, change=letter_dropped), 10)


CODE_PARTS, CODE_SIZE, CODE_ROUNDS, CODE_SCALE = 16, 64, 2, 256


def op13_orchard_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.encode(load(spark, folder, "embeddings"), CODE_PARTS, CODE_SIZE, CODE_ROUNDS, CODE_SCALE)


QUERIES = {f.__name__: f for f in (
    op1_pivot_permutation, op2_compression_language, op3_url_rules, op4_hierarchical_mixing, op5_html_tree_model, op6_odd_sketches,
    op7_best_fit_packing, op8_multi_index_hashing, op9_compression_toxicity, op10_ftrl_quality, op11_wu_manber,
    op12_permuterm_variants, op13_orchard_codes)}

ORACLES = {
    "op1_pivot_permutation": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (
            SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0),
        link AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
            ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
        reach(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT link.a, reach.root FROM reach JOIN link ON link.b = reach.id),
        least AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least.root AS component_id, v.vec_id = least.root AS kept
        FROM v JOIN least ON least.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
    "op3_url_rules": rf"""
        WITH a AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        b AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM a),
        c AS (
            SELECT *, '.' || host AS h, CASE
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM b)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '(^|[^a-z0-9])({"|".join(url_rules.BLOCKED_WORDS)})([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END AS verdict
        FROM c""",
    "op6_odd_sketches": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        same AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        link AS (
            SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same.n >= 85 * (x.n + y.n - same.n)),
        reach(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT link.a, reach.root FROM reach JOIN link ON link.b = reach.id),
        least AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least.root AS component_id, d.doc_id = least.root AS kept
        FROM documents d JOIN least ON least.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op8_multi_index_hashing": f"""
        WITH bits AS (
            SELECT vec_id, list_transform(range(0, {SEARCH_BITS}), lambda i: list_sum(list_transform(
                range(i, len(embedding), {SEARCH_BITS}), lambda k: coalesce(CAST(embedding[k + 1] AS DOUBLE), 0.0))) > 0) AS b
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0),
        pairs AS (
            SELECT q.vec_id AS query_id, r.vec_id, len(list_filter(range(1, {SEARCH_BITS + 1}), lambda i: q.b[i] <> r.b[i])) AS distance
            FROM bits q, bits r WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance FROM ranked WHERE rank <= {SEARCH_K}""",
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op11_wu_manber"] = rf"""
    WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    item AS (SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS l, unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS s
        FROM item WHERE len(w) > 0),
    lengths AS (SELECT DISTINCT l FROM win),
    starts AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM doc, lengths WHERE len(w) >= l),
    here AS (SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS s FROM starts),
    occ AS (SELECT doc_id, item_id, p, here.l FROM here JOIN win ON win.s = here.s AND win.l = here.l),
    hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM occ) GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
    SELECT doc.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit ON hit.doc_id = doc.doc_id LEFT JOIN named ON named.doc_id = doc.doc_id"""

#: crc32 of a list of byte values: the table of its remainders by rule, then one step for each byte.
_CRC_TABLE = (
    "list_transform(range(0, 256), lambda c: list_reduce(range(0, 8), lambda a, k: "
    "CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, c))")

ORACLES["op12_permuterm_variants"] = rf"""
    WITH RECURSIVE run AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
    known AS (SELECT doc_id, r, count(*) AS n FROM run WHERE length(r) >= 7 GROUP BY doc_id, r),
    bytes AS (
        SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''), lambda c: CASE
            WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)) AS b FROM known),
    crc_table AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
    hashed AS (
        SELECT r, n, xor(4294967295, list_reduce(b, lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT))) AS h
        FROM bytes, crc_table),
    written AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word, n FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    place AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
    rest AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM place),
    pair AS (
        SELECT x.word AS a, y.word AS b FROM rest x JOIN rest y ON x.i = y.i AND x.s = y.s AND x.word <> y.word
        UNION SELECT word, s FROM rest WHERE s IN (SELECT word FROM words)
        UNION SELECT s, word FROM rest WHERE s IN (SELECT word FROM words)),
    near AS (
        SELECT a AS word, count(*) AS n_near, arg_max(b, {{'n': w.n, 'first': -k.k}}) AS best
        FROM pair JOIN words w ON w.word = b JOIN (SELECT word, row_number() OVER (ORDER BY word) AS k FROM words) k ON k.word = b GROUP BY a),
    own AS (
        SELECT w.word, w.n, coalesce(near.n_near, 0) AS n_near, CASE WHEN f.n >= 10 * w.n THEN f.word END AS form,
               CASE WHEN f.n >= 10 * w.n THEN f.n END AS form_n
        FROM words w LEFT JOIN near ON near.word = w.word LEFT JOIN words f ON f.word = near.best),
    led(word, top) AS (SELECT word, word FROM own UNION ALL SELECT led.word, own.form FROM led JOIN own ON own.word = led.top WHERE own.form IS NOT NULL),
    ends AS (SELECT led.word, led.top AS root FROM led JOIN own ON own.word = led.top WHERE own.form IS NULL)
    SELECT own.word, form, root, n, n_near, form_n FROM own JOIN ends ON ends.word = own.word"""


def _code_sql() -> str:
    """Starting codebooks, then rounds of assigning every part to its nearest entry and taking means."""
    nearest = """
        near{k} AS (
            SELECT vec_id, part, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, min(d) AS d, any_value(v) AS v
            FROM (SELECT x.vec_id, x.part, x.v, b.entry, CAST(list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.e[i]) * (x.v[i] - b.e[i]))) AS BIGINT) AS d
                  FROM cut x JOIN book{k} b ON b.part = x.part) GROUP BY vec_id, part),"""
    moved = """
        mean{k} AS (
            SELECT part, entry, list(m ORDER BY i) AS e FROM (
                SELECT part, entry, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m FROM near{k}, (SELECT unnest(range(1, {width} + 1)) AS i)
                GROUP BY part, entry, i) GROUP BY part, entry),
        book{next} AS (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{k} b LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry),"""
    rounds = "".join(nearest.format(k=k) + moved.format(k=k, next=k + 1, width="(SELECT len(v) FROM cut LIMIT 1)") for k in range(CODE_ROUNDS))
    return f"""
        WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        kept AS (
            SELECT vec_id, label, list_transform(e, lambda x: CAST(floor({CODE_SCALE} * x) AS BIGINT)) AS v FROM e
            WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS (
            SELECT vec_id, part, v[part * (len(v) // {CODE_PARTS}) + 1:(part + 1) * (len(v) // {CODE_PARTS})] AS v
            FROM kept, (SELECT unnest(range(0, {CODE_PARTS})) AS part)),
        book0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS e FROM cut
            QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {CODE_SIZE}),
        {rounds} {nearest.format(k=CODE_ROUNDS)}
        coded AS (
            SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{CODE_ROUNDS} GROUP BY vec_id),
        digest AS (
            SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) AS s
            FROM (SELECT part, entry, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS i FROM book{CODE_ROUNDS}))
        SELECT c.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
        FROM coded c JOIN kept ON kept.vec_id = c.vec_id, digest"""


ORACLES["op13_orchard_codes"] = _code_sql()
