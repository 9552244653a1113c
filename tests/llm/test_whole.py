"""The whole job where an operator once stopped early."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import rateflow.llm.near_dedup as N
from rateflow.llm.common import sliced
from rateflow.llm.licences import LicenceModel, scan
from rateflow.llm.near_dedup import near_duplicates
from rateflow.llm.neighbours import nearest
from rateflow.llm.url_trust import propagate


def test_near_duplicates_in_a_crowded_bucket(spark, monkeypatch):
    """300 texts that share 0.6 of their words lie in the same bucket of every band; the planted
    pairs among them are found."""
    sign = N._sign

    def collide(batches):
        for b in sign(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array([list(range(1, 21))] * len(b), pa.list_(pa.int64()))], names=b.schema.names)

    monkeypatch.setattr(N, "_sign", collide)
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(60)]
    docs = [(i, " ".join([*common, *(f"w{x}" for x in rng.integers(0, 10**9, 40))])) for i in range(300)]
    # every tenth text has a copy with its last word changed
    docs += [(1000 + i, docs[i][1].rsplit(" ", 1)[0] + " other") for i in range(0, 300, 10)]
    got = {r.doc_id: r.group_id for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in docs}


def test_leaders_of_a_large_group(spark):
    """A group of 300 in the same buckets of all bands has two leaders in all, not two a band."""
    members = spark.range(300).selectExpr("explode(sequence(1L, 20L)) as bucket", "id as node")
    chosen = N._chosen(members).groupBy("bucket").agg(F.sort_array(F.collect_set("other")).alias("others")).collect()
    assert len(chosen) == 20 and len({tuple(r.others) for r in chosen}) == 1 and len(chosen[0].others) == N.LEADERS


def test_links_at_the_threshold():
    """Four fifths of a text's shingles are 0.8 alike to it, whichever comes first."""
    for n in range(1, 60):
        y = np.arange(5 * n, dtype=np.uint64), np.ones(5 * n, np.int64)
        x = y[0][:4 * n], y[1][:4 * n]
        rows = [pa.table({"i": [0, 0], "j": [0, 0], "block": [0, 0], "node": [1, 2], "label": [1, 2],
                          "hashes": [s[0].tobytes() for s in p], "counts": [s[1].tobytes() for s in p]}) for p in ((x, y), (y, x))]
        assert [N._met(0.8)(r).num_rows for r in rows] == [1, 1]


def test_batches_in_slices():
    """A whole batch is never turned into Python objects at once."""
    batch = pa.record_batch([pa.array([f"text {i}" for i in range(2500)])], names=["text"])
    assert [len(b) for b in sliced([batch, batch.slice(0, 0)])] == [1000, 1000, 500]
    got = list(N._with_node([batch]))
    assert max(map(len, got)) == 1000 and pa.concat_arrays([b.column(1) for b in got]).equals(batch.column(0))


def recall(spark, x, queries, **args):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict[int, set] = {}
    for r in nearest(df, F.col("vec_id") % (len(x) // queries) == 0, 20, **args).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in range(0, len(x), len(x) // queries):
        best = [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]
        assert len(found.get(q, ())) == len(best)
        hits, total = hits + len(found[q] & set(best)), total + len(best)
    return hits / total


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
@pytest.mark.parametrize("block", [64, 4096])
def test_neighbours_of_other_norms(spark, norms, block):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 64))[rng.integers(0, 40, 2000)] + 0.7 * rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[7] *= 100
    else:
        x *= rng.lognormal(0, 0.5, (2000, 1))
    assert recall(spark, x, 100, block=block) >= 0.9


@pytest.mark.parametrize("block", [4, 4096])
def test_neighbours_of_small_tables(spark, block):
    x = np.random.default_rng(7).normal(size=(15, 64))
    assert recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True), 15, block=block) == (1.0 if block > 4 else pytest.approx(1.0))


def test_near_dedup_stage_keeps_different_texts(spark):
    text = " ".join(f"w{i}" for i in range(30))
    other = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"]
    rows = [(1, text), (None, text), (None, other[0]), (None, other[1]), (3, other[2]), (3, other[3]), (3, other[3]), (4, other[4]), (4, text),
            (None, other[5]), (None, other[5])]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = sorted(((r.doc_id or 0), r.text) for r in P.near_dedup(spark, docs, "").collect())
    assert got == sorted([(1, text), (0, other[0]), (0, other[1]), (3, other[2]), (3, other[3]), (4, other[4]), (0, other[5])])


def test_ranks_of_a_long_chain(spark):
    n = 20
    edges = [(f"h{i}", f"h{i + 1}", 1) for i in range(n - 1)] + [("h0", "h5", 2), ("h7", "h6", 1)]
    seeds = [(f"h{i}", float(i == 0), float(i == n - 1)) for i in range(n)]
    got = {r.host: (r.trust, r.distrust) for r in propagate(
        spark.createDataFrame(edges, "src string, dst string, weight long"),
        spark.createDataFrame(seeds, "host string, allowed double, blocked double")).collect()}
    w = np.zeros((n, n))
    for a, b, m in edges:
        w[int(a[1:]), int(b[1:])] += m
    for k, m, at in ((0, w, 0), (1, w.T, n - 1)):
        step = m / np.maximum(m.sum(1, keepdims=True), 1)
        want = np.linalg.solve(np.eye(n) - .85 * step.T, .15 * np.eye(n)[at])
        assert [got[f"h{i}"][k] for i in range(n)] == pytest.approx(want, abs=0.01 / n)
        assert all(got[f"h{i}"][k] > 0 for i in range(n))


PLAIN = ["the quick brown fox jumps over the lazy dog near the river", "a second line of ordinary words that says nothing of note",
         "some more text for the reader to see and forget at once", "numbers such as 1 2 3 and names fill this line of the text"]


def test_all_rights_reserved(spark):
    rows = [(1, f"{PLAIN[0]}\nAll rights reserved.\n{PLAIN[1]}"), (2, "Copyright (c) 2021 X Inc. All rights reserved."), (3, "\n".join(PLAIN)),
            (4, "All the rights that were reserved for them were lost")]
    got = {r.doc_id: (r.licence, r.licence_at) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("proprietary", 1), 2: ("proprietary", 0), 3: (None, None), 4: (None, None)}


def test_wrapped_licences(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
    gpl = ("    This program is free software: you can redistribute it and/or modify\n"
           "    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation, either version 3 of the License, or")
    rows = [(1, mit), (2, f"{PLAIN[0]}\n{PLAIN[1]}\n{bsd}"), (3, f"{PLAIN[0]}\n\n{gpl}\n\n{PLAIN[2]}"), (4, "\n".join(PLAIN)),
            (5, "# Permission is hereby granted, free of\n# charge, to any person obtaining\n# a copy of this\n# software"),
            (6, f"{PLAIN[1]}\nReleased under the MIT License.\n{PLAIN[3]}"),
            # a line without words ends a paragraph
            (7, "Redistribution and use in source and\n\nbinary forms, with or without\n\nmodification, are permitted")]
    got = {r.doc_id: (r.licence, r.licence_at, r.n_confirmed) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("mit", 0, 1), 2: ("bsd", 2, 1), 3: ("gpl", 2, 1), 4: (None, None, 0), 5: ("mit", 0, 1), 6: ("mit", 1, 1), 7: (None, None, 0)}


def test_licences_are_learnt_from_every_paragraph(spark):
    """A template word that three of 3,000 paragraphs hold is ordinary, wherever these stand."""
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('line ', id, ' of plain text', if(id in (5, 6, 7), ' by a publisher', '')) as text")
    model = LicenceModel(rows.repartition(4))
    assert "publisher" not in model.content and "permission" in model.content
    assert model.classify(spark.createDataFrame([("Released under the MIT License",), ("line 1 of plain text",)], "paragraph string")).filter("confirmed").count() == 1
