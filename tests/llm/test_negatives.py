"""Hard negatives against all pairs."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import rateflow.llm.hard_negatives as H
from rateflow.llm.oracle import ORACLE
from rateflow.llm.queries import op13_hard_negatives


def brute(rows, every=100):
    """Rows (vec_id, embedding, label) -> the result, by definition; differing rows of one id are told apart."""
    rows = list({(i, tuple(e), x): (i, [int(np.floor(256.0 * float(v))) for v in e], x) for i, e, x in rows
                 if x is not None and e is not None and all(v is not None and np.isfinite(v) for v in e)}.values())
    out = []
    for at, (anchor, u, mine) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(u, e, strict=False)), i is None, i or 0, label == mine, i) for j, (i, e, label) in enumerate(rows) if j != at)
        for score, *_, positive in [r for r in scored if r[3]][:5]:
            fit = [r for r in scored if not r[3] and 30 * -score <= 100 * -r[0] <= 90 * -score][:10]
            out += [(anchor, positive, n + 1, r[4], -score, -r[0]) for n, r in enumerate(fit)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_negatives_of_the_table(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = duckdb.sql(ORACLE["op13_hard_negatives"])
    order = [want.columns.index(c) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    found = got(op13_hard_negatives(spark, f"/root/testdata/{sf}"))
    assert len(found) > 200 and found == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)


def of(spark, rows, every=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"row": F.lit("x"), "cluster": F.lit(None), "x": F.lit(1)})
    return got(H.hard_negatives(df.repartition(3), F.col("vec_id") % every == 0))


def test_clustered_vectors_of_any_length(spark):
    """Directions in groups, norms spread, a third of all rows one vector: pages end early, ties abound."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(12, 16))[rng.integers(0, 12, 6000)] + 0.15 * rng.normal(size=(6000, 16))
    x *= rng.lognormal(0, 0.4, (6000, 1))
    x[::3] = x[0]
    rows = [(i, np.round(v, 3).tolist(), int(k)) for i, (v, k) in enumerate(zip(x, rng.integers(0, 4, 6000), strict=True))]
    assert of(spark, rows, 200) == brute(rows, 200)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 1.0], 1), (100, None, 1), (200, [nan, 1.0], 1), (300, [1.0, None], 2), (400, [inf, 0.0], 2),
            (500, [1.0, 1.0], None), (600, [], 1), (700, [0.0, 0.0], 2), (None, [1.0, 2.0], 1), (None, [0.5, 1.0], 2), (None, None, None),
            (1, [0.6, 1.0], 2), (2, [0.6, 1.0], 2), (3, [0.5, 0.4, 3.0], 3), (4, [-1.0, -2.0], 2), (800, [3.0], 3), (5, [1e12, 1e12], 1), (6, [3e11, 1.0], 2), (900, [1e12, 2.0], 1)]
    assert of(spark, rows) == brute(rows)
    assert of(spark, []) == [] and of(spark, [(1, [1.0], 1)]) == [] and of(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []


def test_products_are_exact():
    x = np.array([[2.0**40, -(2.0**30) + 1, 3], [1, 2, 3]])
    assert H.products(x, x).tolist() == [[min(sum(int(a) * int(b) for a, b in zip(r, s, strict=True)), H.BEST) for s in x] for r in x]


def test_lists_end_early(spark):
    """The bound is one, and of clustered directions most rows are below it."""
    rng = np.random.default_rng(9)
    x = H.unit(rng.normal(size=(8, 32))[rng.integers(0, 8, 4000)] * 3 + 0.2 * rng.normal(size=(4000, 32)))[0] * 256
    lists = H.Lists(H.centres(x), 32, np.zeros(8))
    near = np.argmax(x @ lists.centre.T, axis=1)
    for c in range(8):
        lists.angle[c] = np.arccos(np.clip(x[near == c] @ lists.centre[c] / 256, -1, 1)).max()
    bound = lists.bounds(x)
    scores = x @ x.T / 256
    assert all((scores[i] <= bound[:, near[i]] * (1 + 1e-9)).all() for i in range(0, 4000, 50))
    tenth = np.sort(scores, axis=1)[:, -10]
    assert np.mean([(bound[:, near[i]] >= tenth[i]).mean() for i in range(0, 4000, 50)]) < 0.3
