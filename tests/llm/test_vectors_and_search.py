"""Pivot index and Hamming search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverloom.llm import hamming, pivot_index
from silverloom.llm.components import components
from tests.conftest import SF


def brute_components(ids, links):
    label = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return label


def test_components_of_chains_stars_loops_and_repeats(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 30)] + [(50, 50), (51, 52), (52, 51), (51, 52), (60, 61), (62, 61), (63, 62)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if i != 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    g = np.random.default_rng(5)
    base = g.normal(size=(40, 16))
    rows = [base[k % 40] + g.normal(size=16) * (0.02 + 0.1 * (k % 3)) for k in range(300)]
    rows += [base[0] * s for s in (1.0, 2.0, 1e-200, 1e150)] + [rows[3]] * 30  # scaled ones, a group of copies
    rows = [[float(x) for x in r] for r in rows]
    odd = [None, [], [0.0] * 16, [-0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]]
    return [(k, r) for k, r in enumerate(rows + odd)]


def brute_links(rows, least):
    good = {k: np.array(v, dtype=float) for k, v in rows if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)}
    good = {k: v / np.abs(v).max() for k, v in good.items()}
    out = []
    for a, x in good.items():
        for b, y in good.items():
            if a < b and len(x) == len(y) and (np.array_equal(x, y) or x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least):
                out.append((a, b))
    return out


def test_pivot_index_equals_brute_force_on_every_kind_of_vector(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("pivot", F.lit("extra")).withColumn("n", F.lit(1))
    got = {r["vec_id"]: r for r in pivot_index.near_vectors(df).collect()}
    links = brute_links(rows, 0.95)
    label = brute_components([k for k, _ in rows], links)
    found = sum(r["n_links"] for r in got.values())
    assert found <= 2 * len(links) and found >= 0.9 * 2 * len(links)
    assert found == 2 * len(links)
    assert {k: r["component_id"] for k, r in got.items()} == label
    assert all(r["kept"] == (k == label[k]) for k, r in got.items())


def test_dense_list_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivot_index, "BLOCK", 20)
    g = np.random.default_rng(8)
    base = g.normal(size=16)
    rows = [(k, [float(x) for x in base + g.normal(size=16) * 0.01]) for k in range(130)]
    got = pivot_index.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(129, 0)}


def test_pivot_index_of_nothing(spark):
    assert pivot_index.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def brute_top(rows, queries, k):
    out = []
    for q, code in queries:
        if code is not None:
            near = sorted((bin(code ^ c).count("1"), i) for i, c in rows if c is not None)[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("segments", [None, 1, 2, 3, 5])
def test_hamming_equals_brute_force(spark, segments):
    g = np.random.default_rng(3)
    rows = [(k, int(g.integers(0, 1 << 16))) for k in range(200)] + [(300 + k, 77) for k in range(25)] + [(400, None), (401, 0), (401, 0)]
    queries = [(0, rows[0][1]), (1, 77), (2, None), (3, 0), (4, 65535), (5, 77)]
    got = hamming.top_k(spark.createDataFrame(rows, "vec_id long, code long"), spark.createDataFrame(queries, "query_id long, code long"), 7, 16, segments)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "distance").collect()) == brute_top(rows, queries, 7)


def test_hamming_with_fewer_rows_than_k_and_with_none(spark):
    rows = spark.createDataFrame([(1, 5), (2, 250)], "vec_id long, code long")
    got = hamming.top_k(rows, rows.withColumnRenamed("vec_id", "query_id"), 10, 8)
    assert sorted(tuple(r) for r in got.collect()) == sorted([(1, 1, 1, 0), (1, 2, 2, 8), (2, 1, 2, 0), (2, 2, 1, 8)])
    assert hamming.top_k(rows.limit(0), rows.withColumnRenamed("vec_id", "query_id"), 10, 8).count() == 0


def test_sign_codes(spark):
    df = spark.createDataFrame([([1.0, -1.0, 2.0, 0.5],), (None,), ([],), ([None, float("nan"), -1.0, 3.0],)], "v array<double>")
    assert [r[0] for r in df.select(hamming.sign_code(F.col("v"), 2)).collect()] == [0b01, None, None, 0b10]


def test_index_recall_on_the_given_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = pivot_index.near_vectors(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert got.agg(F.sum("n_links")).first()[0] == 2 * len(brute_links(rows, 0.95))
