"""Quality scores: held-out accuracy, the sums against numpy, monotone calibration, odd inputs."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import rateflow.llm.quality_model as Q
from rateflow.llm.queries import op11_quality_classifier

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op11_quality_classifier(spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    for label, least in ((1, 0.99), (0, 0.95)):
        held = [got[i].predicted == label for i, y in rows if y == label and got[i].held_out]
        assert len(held) > 100 and np.mean(held) >= least
    good, bad = (np.array([got[i].score for i, y in rows if y == label and got[i].held_out]) for label in (1, 0))
    assert (good[:, None] > bad).mean() > 0.99


def test_fit_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(Q.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=400) > 1).astype(int)
    measured = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, stats array<double>").repartition(5)
    # 30 and 31 have two labels; unusable ones and those of unknown documents do not count
    labels = [(i, int(v)) for i, v in enumerate(y)] + [(30, 0), (31, 1), (None, 1), (32, None), (33, 7), (5000, 0)]
    model = Q.fit(measured, spark.createDataFrame(labels, "doc_id long, quality int"))
    target = y.astype(float)
    target[30], target[31] = (y[30] + 0) / 2, (y[31] + 1) / 2
    assert model.mean == pytest.approx(x.mean(0)) and model.spread == pytest.approx(x.std(0))
    z = model.features(x) / 4096
    ridge = np.diag([model.penalty * 400] * Q.FEATURES + [1e-9 * 400])
    assert model.weights[-1] == pytest.approx(np.linalg.solve(z.T @ z + ridge, z.T @ target), abs=1e-3)
    fold = np.array([r.f for r in measured.orderBy("doc_id").select(F.pmod(F.xxhash64("doc_id"), F.lit(Q.FOLDS)).alias("f")).collect()])
    errors = []
    for p in Q.PENALTIES:
        e = 0
        for f in range(Q.FOLDS):
            a, b = z[fold != f], z[fold == f]
            w = np.linalg.solve(a.T @ a + np.diag([p * len(a)] * Q.FEATURES + [1e-9 * len(a)]), a.T @ target[fold != f])
            e += ((b @ w - target[fold == f]) ** 2).sum()
        errors.append(e)
    assert model.penalty == Q.PENALTIES[int(np.argmin(errors))]
    curve = model.calibrated(np.linspace(-1, 2, 500))
    assert (np.diff(curve) >= 0).all() and 0 <= curve.min() and curve.max() <= 1


def test_pooled_blocks():
    at, to = Q.pooled(np.arange(6.0), np.array([0, 1, 0, 0, 1, 1.0]), np.array([1, 1, 1, 2, 1, 1.0]))
    assert at == pytest.approx([0, (1 + 2 + 6) / 4, 4.5]) and to == pytest.approx([0, 0.25, 1])


@pytest.mark.parametrize("labels", [[], [(1, 1), (3, 1)], [(3, 0), (4, 1)], [(1, 0), (2, 1), (3, 1), (4, 0), (5, 0), (6, 1), (None, 1)]])
def test_odd_documents(spark, odd, none, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    for docs in (odd, none):
        measured = Q.measure(docs).cache()
        rows = Q.score(measured, Q.fit(measured, known)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        if docs is odd:
            assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # null and empty
            if not labels:
                assert {r.score for r in rows} == {0.5}
            elif all(y == 1 for _, y in labels):
                assert {r.score for r in rows} == {1.0}


def test_statistics_of_a_very_long_text():
    assert np.isfinite(Q.statistics("word " * (1 << 20) + "end")).all()
    assert (Q.statistics(None) == 0).all() and (Q.statistics(" \n") == 0).all()
