"""Pages, embeddings and the pipeline."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from rateflow.llm import queries as Q
from rateflow.llm.components import components
from rateflow.llm.neighbours import nearest
from rateflow.llm.url_trust import judge, propagate

SF = "/root/testdata/sf0.001"
on_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_url_rules_and_odd_urls(spark):
    urls = ["http://A.Example.NET/en/x?y", "http://example.net/de/", "https://net", "x://b.example.com/de/1#z", "x://notexample.com/de/1",
            "http://w.ORG/fr/", "no host", None, "http://ß.org/FR/", "http://a.org/fr/?://b"]
    want = [("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "/de/", "net/", "block"), ("net", "", None, "allow"),
            ("b.example.com", "/de/1", "example.com/de/", "block"), ("notexample.com", "/de/1", None, "allow"), ("w.org", "/fr/", "org/fr/", "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("ß.org", "/FR/", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow")]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge(pages).collect()}
    assert [got[i][:3] for i in range(len(urls))] == [w[:3] for w in want]
    assert [got[i][3] for i, w in enumerate(want) if w[2]] == [w[3] for w in want if w[2]]
    assert judge(pages.limit(0)).count() == 0


def test_distrust_runs_against_links(spark):
    link = '<a href="http://%s/x">x</a>'
    rows = [(1, "http://bad.net/1", ""), (2, "http://farm.com/", link % "bad.net" * 9), (3, "http://good.org/fr/", link % "nice.com"), (4, "http://nice.com/", None)]
    rows += [(10 + i, f"http://h{i}.com/", "") for i in range(6)]
    got = {r.host: r.verdict for r in judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got["farm.com"] == "block" and got["nice.com"] == got["h0.com"] == "allow"


def test_ranks_equal_power_iteration(spark):
    rng = np.random.default_rng(3)
    w = rng.integers(0, 3, (6, 6)) * (1 - np.eye(6, dtype=int))
    edges = [(f"h{i}", f"h{j}", int(w[i, j])) for i in range(6) for j in range(6) if w[i, j]]
    seeds = [(f"h{i}", float(i == 0), float(i > 3)) for i in range(6)]
    got = {r.host: (r.trust, r.distrust) for r in propagate(
        spark.createDataFrame(edges, "src string, dst string, weight long"), spark.createDataFrame(seeds, "host string, allowed double, blocked double"), 5).collect()}
    for k, m, s in ((0, w, np.eye(6)[0]), (1, w.T, np.array([0, 0, 0, 0, .5, .5]))):
        step, rank = m / np.maximum(m.sum(1, keepdims=True), 1), s.copy()
        for _ in range(5):
            rank = .15 * s + .85 * rank @ step
        assert [got[f"h{i}"][k] for i in range(6)] == pytest.approx(rank)


def check_recall(rows, vectors, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    hits = total = 0
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in ids if i % 20 == 0}
    for q, got in found.items():
        got.sort()
        score = x @ np.array(vectors[q])
        others = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        assert [g[0] for g in got] == list(range(1, len(others) + 1))
        assert [g[2] for g in got] == pytest.approx([float(np.dot(vectors[g[1]], vectors[q])) for g in got])
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        hits += len({g[1] for g in got} & set(ids[others]))
        total += len(others)
    return hits / total


@on_tables
def test_neighbours_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in rows}
    assert check_recall(Q.op9_cross_polytope(spark, SF).collect(), vectors, 20) >= 0.9


def test_neighbours_by_inner_product_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 10)) * rng.uniform(0.2, 3, (600, 1))
    x[50:90] = x[40]  # a class of equal vectors
    vectors = {i: x[i] for i in range(600)}
    rows = [(i, v.tolist(), "e") for i, v in vectors.items()]
    odd = [(600, None, "e"), (620, [0.0] * 10, "e"), (640, [None, *[1.0] * 9], "e"), (660, [float("nan")] * 10, "e"), (680, [1.0], "e"), (None, [1.0] * 10, "e")]
    df = spark.createDataFrame([*rows, *odd, rows[0]], "vec_id long, embedding array<double>, score string")
    got = nearest(df, F.col("vec_id") % 20 == 0, 20, block=100).collect()
    assert check_recall(got, vectors, 20) >= 0.9
    assert nearest(df.limit(0), F.lit(True)).count() == 0
    few = nearest(df.filter("vec_id < 3"), F.col("vec_id") == 0, 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_neighbours_of_rows_that_repeat_an_id(spark):
    """30 rows of one id and 34 other ids with the same vector: all of the nearest are such ids."""
    rng = np.random.default_rng(8)
    near, far = [1.0, *[0.0] * 9], rng.normal(size=(60, 10))
    far = 0.5 * far / np.linalg.norm(far, axis=1, keepdims=True)
    rows = [(5, near)] * 30 + [(i, near) for i in range(6, 40)] + [(100 + i, v.tolist()) for i, v in enumerate(far)]
    df = spark.createDataFrame([(i, v, 1, 1, 1.0) for i, v in rows], "vec_id long, embedding array<double>, class int, range int, weight double")
    got = sorted((r.rank, r.vec_id, r.score) for r in nearest(df, F.col("vec_id") == 5, 20).collect())
    assert got == [(i + 1, 6 + i, 1.0) for i in range(20)]


def test_neighbours_hash_and_score_a_part(spark):
    """Most rows lie in no probed bucket, and the result is whole."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)] + 0.3 * rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") % 100 == 0, 20, block=700).collect()
    effort = {r.query_id: r.n_scored for r in got}
    assert len(effort) == 40 and np.mean(list(effort.values())) < 0.2 * len(x)
    hits = sum(r.vec_id in set(sorted((i for i in range(len(x)) if i != r.query_id), key=(-(x @ x[r.query_id])).__getitem__)[:20]) for r in got[:200])
    assert len(got) == 800 and hits >= 180


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 60)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_stage_takes_odd_and_empty_tables(spark, odd, none, tmp):
    for name, docs in (("odd", odd), ("none", none)):
        for i, (stage, f) in enumerate(P.STAGES):
            out = f(spark, docs, SF)
            out.write.parquet(f"{tmp}/{name}-{stage}")
            if i < len(P.STAGES) - 1:
                assert out.columns == docs.columns
                docs = spark.read.parquet(f"{tmp}/{name}-{stage}")


def test_stages_decide_as_their_operators(spark, odd):
    def ids(f):
        return sorted((r.doc_id or 0) for r in f(spark, odd, SF).collect())

    assert not {1, 2, 5} & set(ids(P.language))
    near = ids(P.near_dedup)
    assert near.count(1) == 1 and 2 not in near and 5 in near
    assert set(ids(P.mixing)) == {r.doc_id or 0 for r in odd.collect()}


def test_suffix_dedup_stage_keeps_every_column(spark):
    """Columns ride along whatever their names, null texts go, and cuts are the operator's."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "first " + passage, 5, "k1"), (2, passage + " rest", 6, None), (3, None, 7, "k3"), (4, "short é", 8, "k4"), (4, "short é", 8, "k4")]
    docs = spark.createDataFrame([(*r, "s", "r") for r in rows], "doc_id int, text string, n_chars int, k string, spans string, _row string")
    out = P.suffix_dedup(spark, docs, SF)
    assert out.schema == docs.schema
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, rows[0][1], len(rows[0][1]), "k1", "s", "r"), (2, " rest", 5, None, "s", "r"), (4, "short é", 7, "k4", "s", "r"), (4, "short é", 7, "k4", "s", "r")]


@on_tables
def test_pipeline_equals_its_stages(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (_, f) in enumerate(P.STAGES):
        f(spark, docs, SF).write.parquet(f"{tmp}/{i}")
        docs = spark.read.parquet(f"{tmp}/{i}")
    columns = ["doc_id", "start", "length", "doc_tokens"]
    assert sorted(map(tuple, P.run(spark, SF).select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))
