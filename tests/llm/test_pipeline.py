"""Each stage of the pipeline against a plain version on its own input, and the whole."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from silverloom.llm import language, mixing, packing, quality
from silverloom.llm.queries import MIX_WEIGHTS, domain, held_out
from tests.conftest import SF
from tests.llm.test_near_duplicates import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        out.append((docs, docs := spark.read.parquet(f"{root}/{name}")))
    return dict(zip([n for n, _ in cp.STAGES], out))


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_columns_stay(spark, stages):
    want = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(out.columns == want for name, (_, out) in stages.items() if name != "packing")


def test_quality_keeps_what_the_model_scores(spark, stages):
    docs, out = stages["quality"]
    w = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~held_out("quality"))

    def score(text):
        one, two, n = quality.features(text, quality._Words())
        total = w[-1] + sum(s * sum(float(w[k]) for k in places) for s, places in zip(quality.SCALES, (one, two))) / max(1, n)
        return 1 / (1 + 2.718281828459045 ** -total)

    assert ids(out) == sorted(r["doc_id"] for r in docs.collect() if score(r["text"]) >= cp.LEAST_QUALITY)
    good = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").join(docs, "doc_id", "left_semi")
    assert good.join(out, "doc_id", "left_anti").count() <= 0.02 * good.count()
    assert out.count() < docs.count()


def test_language_keeps_what_is_sure(spark, stages):
    docs, out = stages["language"]
    read = language.Reader(language.train(docs, ~held_out("lang")))
    got = {r["doc_id"]: read(r["text"]) for r in docs.collect()}
    assert ids(out) == sorted(i for i, (lang, _, margin) in got.items() if lang != "und" and margin >= language.NARROW)
    assert out.count() >= 0.97 * docs.count()


def test_one_of_each_group_stays(stages):
    docs, out = stages["near_duplicates"]
    assert ids(out) == sorted(i for i, _, _, kept in brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80) if kept)


def test_missing_and_repeated_ids_cost_no_text(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    near = lambda k: text(k) + " end"
    rows = [(None, text(1)), (None, text(2)), (None, near(1)), (None, None), (7, text(3)), (7, text(4)), (7, near(4)), (7, text(4)), (8, near(3)),
            (9, text(5)), (None, text(5)), (5, near(2)), (3, text(6)), (-2, near(6))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(str, map(tuple, cp.without_near_duplicates(spark, df, SF).collect())))
    assert len(got) == 7
    one_of = [[(None, text(1)), (None, near(1))], [(None, None)], [(5, near(2))], [(7, text(3))], [(7, text(4)), (7, near(4))], [(9, text(5))], [(-2, near(6))]]
    assert all(sum(str(x) in got for x in group) == 1 for group in one_of)


def test_mixing_takes_the_budgets(stages):
    docs, out = stages["mixing"]
    n = mixing.word_count(F.col("text"))
    path = [domain(F.col("source")), F.col("lang"), F.col("source")]
    sizes = {tuple(r)[:3]: r[3] for r in docs.groupBy(*path).agg(F.sum(n)).collect()}
    largest = {tuple(r)[:3]: r[3] for r in docs.groupBy(*path).agg(F.max(n)).collect()}
    got = Counter({tuple(r)[:3]: r[3] for r in out.groupBy(*path).agg(F.sum(n)).collect()})
    for leaf, budget in mixing.budgets(sizes, MIX_WEIGHTS, int(cp.MIX_SHARE * sum(sizes.values())), 1).items():
        assert budget <= got[leaf] <= budget + largest[leaf]
    assert len(ids(out)) == len(set(ids(out)))


def test_every_document_is_packed(stages):
    docs, out = stages["packing"]
    encode = packing.public_encoder()
    want = Counter((r["doc_id"], p, n) for r in docs.collect() for p, n in enumerate(packing.cut(len(encode(r["text"])) // 4 + 1, packing.CAPACITY)))
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in out.collect()) == want
    used = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert used.filter("n <> end OR n > 2048").count() == 0


def test_stages_on_odd_rows_and_on_nothing(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = [(1, None, None, None, None), (2, "", "en", "src0", 0), (3, "a", "en", "src3", 1), (3, "a", "en", "src3", 1), (None, "x y z", "de", None, 5),
           (4, "long " * 60_000, "de", "src12", 1), (5, "a b c d e f g", "en", "odd name", 3), (6, "a b c d e f g", "en", "src99999999999", 3)]
    base = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_leaf", F.lit("extra")).withColumn("_kept", F.lit(1)).withColumn("score", F.lit(0.5))
    docs = base.limit(120).unionByName(spark.createDataFrame(odd, schema), allowMissingColumns=True)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 0
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_registered(spark):
    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()
    assert [n for n, _ in cp.STAGES] == ["quality", "language", "near_duplicates", "mixing", "packing"]
    assert sum(q.startswith("op") and q[2].isdigit() for q in entry.queries()) == 13
