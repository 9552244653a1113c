"""Hard negatives by lists that the anchors of a cluster share (MAXIMUS; Abuzaid et al., 2019).

Anchors are clustered by direction (spherical k-means). For a cluster with centre c, whose members
are within the angle t of it, no member u scores more than |u| |i| cos(max(0, angle(i, c) - t)) with a row i.
So each cluster sorts the rows once by |i| cos(...), and every member walks that list from the top,
until the bound of what follows is below all that it still needs: its termination is certified, and
the result is exact.

The list of a cluster is cut into pages by a histogram of the bounds (``BINS`` numbers a cluster), each
``GROWTH`` times as long as the one before. In a round, the members that are not yet certified
meet one page of their list, in blocks of at most ``ROWS`` rows and ``MEMBERS`` members; a task
sorts its block by the bound, and its members walk it. The first walk finds each anchor's positives
(best rows of its label). These give the ranges of scores in which the second walk finds
negatives (best rows of other labels within the range).

Components are compared as whole numbers, floor(256 * x). Products are summed in double precision
where they are exact, in Python's whole numbers otherwise; scores beyond 64 bits are cut to them.

Defined cases: rows with a null label, a null vector or null or non-finite components take no
part; rows that repeat id, label and vector count once, and rows of one id that differ are different rows; a null
id is no anchor and comes last among equal scores; shorter vectors are filled up with zeros; an
anchor without positives, or a positive without negatives, gives no rows; an empty table gives an empty result;
extra columns are ignored.

Hot groups: equal vectors share a place in every list, but are dealt to blocks by their row's
number. Where directions are spread evenly, no bound helps, and all anchors meet all rows in blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from rateflow.llm.common import written

#: Clusters, and anchors (by a hash) on which their centres are fitted; every anchor is assigned.
CLUSTERS, SAMPLE = 8, 4096
BINS, PAGE, GROWTH = 512, 4096, 8
ROWS, MEMBERS, CHUNK = 32768, 4096, 1024
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
WORST, BEST = -(2**63) + 1, 2**63 - 1
#: Angles are widened by this much, for the rounding of the arc cosine.
SLACK = 1e-6


def whole(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """floor(256 * x) of each component, filled up to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows, as 64-bit numbers."""
    most = np.linalg.norm(x, axis=1).max(initial=0) * np.linalg.norm(y, axis=1).max(initial=0)
    if most < 2.0**52:
        return (x @ y.T).astype(np.int64)  # no sum of a part is larger than the norms' product
    big = np.array([[int(v) for v in r] for r in x], object).reshape(x.shape) @ np.array([[int(v) for v in r] for r in y], object).reshape(y.shape).T
    return np.clip(big, WORST, BEST).astype(np.int64)


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay), and the lengths."""
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def centres(x: np.ndarray, clusters: int = CLUSTERS, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; the first centres are far from one another."""
    x, norm = unit(x)
    x = x[norm > 0] if norm.any() else x[:1]
    chosen = [0]
    while len(chosen) < min(clusters, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    c = x[chosen]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        c = np.array([unit(x[near == i].sum(axis=0, keepdims=True))[0][0] if (near == i).any() else c[i] for i in range(len(c))])
    return c


@dataclass
class Lists:
    """The clusters' lists: centres, widest angle of a member, and pages of bins (from, to), from the top."""

    centre: np.ndarray
    width: int
    angle: np.ndarray
    most: float = 1.0
    counts: np.ndarray | None = None  # clusters x bins
    pages: list[list[tuple[int, int]]] | None = None

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Upper bound of each row's score with each cluster's members of length one."""
        u, norm = unit(x)
        apart = np.arccos(np.clip(u @ self.centre.T, -1, 1))
        return norm[:, None] * np.cos(np.maximum(0, apart - self.angle - SLACK))

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        return np.clip((bounds / self.most + 1) * (BINS / 2), 0, BINS - 1).astype(np.int32)

    def top(self, upto: int) -> float:
        """What no row in the bins below ``upto`` exceeds."""
        return (upto * 2 / BINS - 1) * self.most * (1 + 1e-9) + 1e-9

    def cut(self) -> None:
        self.pages = []
        for counts in self.counts:
            pages, end, held, size = [], BINS, 0, PAGE
            for b in range(BINS - 1, -1, -1):
                held += counts[b]
                if held >= size or (b == 0 and held):
                    pages.append((b, end))
                    end, held, size = b, 0, size * GROWTH
            self.pages.append(pages)


_FOUND = pa.schema([("row", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("other", pa.int64()), ("vec_id", pa.int64())])
_FOUND_DDL = "row long, slot int, score long, other long, vec_id long"


def _walk(lists: Lists, k: int, alike: bool):
    """One block: its rows sorted by the cluster's bound, and every member's walk down to where it is certified."""

    def run(members: pa.Table, rows: pa.Table) -> pa.Table:
        if not members.num_rows or not rows.num_rows:
            return _FOUND.empty_table()
        cluster = members["cluster"][0].as_py()
        x, u = whole(rows["x"], lists.width), whole(members["x"], lists.width)
        bound = lists.bounds(x)[:, cluster]
        order = np.argsort(-bound, kind="stable")
        x, bound = x[order], bound[order]
        row, label, ids, nameless = (c.to_numpy()[order] for c in (
            rows["row"], rows["label"], rows["vec_id"].fill_null(0), rows["vec_id"].is_null()))
        own, mine, length = members["row"].to_numpy(), members["label"].to_numpy(), np.linalg.norm(u, axis=1)
        ranges = members["slots"].to_pylist()
        found = [[(s["lo"], s["hi"], s["least"], np.empty(0, np.int64), np.empty(0, np.int64)) for s in r] for r in ranges]
        going = np.arange(len(u))
        for at in range(0, len(x), CHUNK):
            most = bound[at] * length[going] * (1 + 1e-9) + 1e-9
            # what follows may still matter to a member: to a slot, above what it has and within its range
            going = going[[any(m >= least and m >= lo for lo, _, least, _, _ in found[i]) for i, m in zip(going, most, strict=True)]]
            if not len(going):
                break
            part = slice(at, at + CHUNK)
            scores = products(u[going], x[part])
            fits = ((label[part] == mine[going, None]) == alike) & (row[part] != own[going, None])
            for i, s, fit in zip(going, scores, fits, strict=True):
                near = np.flatnonzero(fit & (s >= min(f[0] for f in found[i])) & (s <= max(f[1] for f in found[i])))
                near = near[np.lexsort((row[part][near], ids[part][near], nameless[part][near], -s[near]))]
                sorted_ = -s[near]
                for j, (lo, hi, least, old, old_at) in enumerate(found[i]):
                    new = near[np.searchsorted(sorted_, -hi):][:k]
                    new = new[s[new] >= max(lo, least)]
                    if len(new):
                        score, place = np.concatenate([old, s[new]]), np.concatenate([old_at, new + at])
                        best = np.lexsort((row[place], ids[place], nameless[place], -score))[:k]
                        score = score[best]
                        found[i][j] = (lo, hi, max(least, int(score[-1])) if len(best) == k else least, score, place[best])
        out = [(own[i], ranges[i][j]["slot"], s, p) for i, slots in enumerate(found) for j, (_, _, _, score, place) in enumerate(slots) for s, p in zip(score, place, strict=True)]
        place = np.array([p for *_, p in out], np.int64)
        return pa.table([
            pa.array([r for r, *_ in out], pa.int64()), pa.array([s for _, s, *_ in out], pa.int32()), pa.array([s for *_, s, _ in out], pa.int64()),
            pa.array(row[place], pa.int64()), rows["vec_id"].take(pa.array(order[place]))], schema=_FOUND)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """``row``, ``slot`` and ``best``: the ``k`` first of what was found (a few of each block)."""
    one = F.struct((-F.col("score")).alias("far"), F.col("vec_id").isNull().alias("nameless"), "vec_id", "other")
    return found.groupBy("row", "slot").agg(F.slice(F.array_sort(F.collect_list(one)), 1, k).alias("best"))


def _walked(points: DataFrame, members: DataFrame, lists: Lists, k: int, alike: bool) -> DataFrame:
    """``row``, ``slot`` and ``best`` of every member (row, vec_id, label, x, cluster, norm, slots) that finds any row: round by
    round, each with the next page, until all are certified."""
    best: DataFrame | None = None
    for r in range(max(len(p) for p in lists.pages)):
        active = {x.cluster: x["count"] for x in members.groupBy("cluster").count().collect()}  # one number a cluster
        active = {c: n for c, n in active.items() if r < len(lists.pages[c])}
        if not active:
            break
        bins = {c: lists.pages[c][r] for c in active}
        blocks = {c: -(-int(lists.counts[c][lo:hi].sum()) // ROWS) for c, (lo, hi) in bins.items()}
        sides = {c: -(-n // MEMBERS) for c, n in active.items()}

        def paged(batches, bins=bins, blocks=blocks):
            for batch in batches:
                at = lists.bins(lists.bounds(whole(batch.column(3), lists.width)))
                row = batch.column(0).to_numpy()
                for c, (lo, hi) in bins.items():
                    here = np.flatnonzero((at[:, c] >= lo) & (at[:, c] < hi))
                    if len(here):
                        # consecutive numbers of a task go to different blocks
                        block = pa.array((row[here] % blocks[c]).astype(np.int32))
                        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(here)).columns, pa.array(np.full(len(here), c, np.int32)), block], names=[*batch.schema.names, "cluster", "block"])

        def of(numbers: dict[int, int]) -> Column:  # a few literals
            return F.element_at(F.create_map(*[F.lit(v) for kv in numbers.items() for v in kv]), F.col("cluster"))

        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
        rows = points.mapInArrow(paged, f"{kind}, cluster int, block int").withColumn("side", F.explode(F.sequence(F.lit(0), of(sides) - 1)))
        asking = members.filter(F.col("cluster").isin(list(active))).withColumns({
            "side": F.pmod(F.xxhash64("row"), of(sides)).cast("int"), "block": F.explode(F.sequence(F.lit(0), of(blocks) - 1))})
        place = "cluster", "block", "side"
        found = (
            asking.select(*place, "row", "label", "x", "slots").groupBy(*place).cogroup(rows.select(*place, "row", "vec_id", "label", "x").groupBy(*place))
            .applyInArrow(_walk(lists, k, alike), _FOUND_DDL))
        if best is not None:
            found = found.union(best.select("row", "slot", F.explode("best").alias("b")).select("row", "slot", (-F.col("b.far")).alias("score"), "b.other", "b.vec_id"))
        best = written(_best(found, k), "best")
        # who goes on: those to whom the next page may matter
        tops = {c: lists.top(lists.pages[c][r + 1][1]) for c in active if r + 1 < len(lists.pages[c])}
        if not tops:
            break
        least = best.filter(F.size("best") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", (-F.col("best")[k - 1]["far"]).alias("least")))).alias("least"))
        next_top = F.element_at(F.create_map(*[F.lit(v) for kv in tops.items() for v in kv]), F.col("cluster")) * F.col("norm") * (1 + 1e-9) + 1e-9
        members = members.filter(F.col("cluster").isin(list(tops))).join(least, "row", "left").withColumn("slots", F.transform("slots", lambda s: F.struct(
            s["slot"].alias("slot"), s["lo"].alias("lo"), s["hi"].alias("hi"), F.greatest(s["least"], F.element_at("least", s["slot"])).alias("least")))).drop("least")
        members = written(members.filter(F.exists("slots", lambda s: (next_top >= s["lo"]) & (next_top >= s["least"]))), "members")
    return best


def _slot(number: Column, lo: Column, hi: Column) -> Column:
    return F.struct(number.cast("int").alias("slot"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"), F.lit(WORST).alias("least"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, clusters: int = CLUSTERS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``: for each row of
    ``vectors`` (vec_id, embedding, label) that is an anchor and each of its first ``POSITIVES`` rows of the same label,
    the first ``NEGATIVES`` rows of other labels that score ``LOW`` to ``HIGH`` per cent of the positive."""
    spark = vectors.sparkSession
    element = FloatType() if vectors.schema["embedding"].dataType == ArrayType(FloatType()) else DoubleType()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast(ArrayType(element)).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad).dropDuplicates(["vec_id", "label", "x"])
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "points").select("row", "vec_id", "label", "x", "anchor")
    points, anchors = rows.drop("anchor"), rows.filter("anchor").drop("anchor")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = rows.agg(F.max(F.size("x")).alias("n")).collect()[0].n
    sample = pa.array([r.x for r in anchors.orderBy(F.xxhash64("row")).limit(SAMPLE).select("x").collect()], pa.list_(pa.float64()))
    if not len(sample):
        return spark.createDataFrame([], result)
    width = max(width, 1)
    lists = Lists(centres(whole(sample, width), clusters), width, np.empty(0))

    def assigned(batches):
        for batch in batches:
            u, norm = unit(whole(batch.column(3), width))
            near = u @ lists.centre.T
            cluster = np.argmax(near, axis=1)
            angle = np.where(norm > 0, np.arccos(np.clip(near[np.arange(len(u)), cluster], -1, 1)), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster.astype(np.int32)), pa.array(norm), pa.array(angle)], names=[*batch.schema.names, "cluster", "norm", "angle"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    members = written(anchors.mapInArrow(assigned, f"{kind}, cluster int, norm double, angle double"), "anchors")
    lists.angle = np.zeros(len(lists.centre))
    for r in members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():  # one number a cluster
        lists.angle[r.cluster] = r.angle

    def longest(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max((unit(whole(b.column(3), width))[1].max(initial=0.0) for b in batches), default=0.0)])], names=["norm"])

    lists.most = max(points.mapInArrow(longest, "norm double").agg(F.max("norm").alias("n")).collect()[0].n, 1e-9)

    def counted(batches):
        counts = np.zeros((len(lists.centre), BINS), np.int64)
        for batch in batches:
            at = lists.bins(lists.bounds(whole(batch.column(3), width)))
            for c in range(len(counts)):
                counts[c] += np.bincount(at[:, c], minlength=BINS)
        cluster, some = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[cluster, some])], names=["cluster", "bin", "n"])

    lists.counts = np.zeros((len(lists.centre), BINS), np.int64)
    for r in points.mapInArrow(counted, "cluster int, bin int, n long").groupBy("cluster", "bin").agg(F.sum("n").alias("n")).collect():
        lists.counts[r.cluster, r.bin] = r.n
    lists.cut()

    whole_range = F.array(_slot(F.lit(0), F.lit(WORST), F.lit(BEST)))
    positives = _walked(points, members.withColumn("slots", whole_range), lists, POSITIVES, alike=True)
    scored = positives.select("row", F.posexplode("best").alias("slot", "p")).select(
        "row", "slot", F.col("p.vec_id").alias("positive_id"), (-F.col("p.far")).alias("positive_score"))
    # a score s fits if LOW * p <= 100 * s <= HIGH * p; no score does if p < 0
    wide = F.col("positive_score").cast("decimal(20,0)")
    lo, hi = F.ceil(wide * LOW / 100), F.floor(wide * HIGH / 100)
    ranges = scored.filter("positive_score >= 0").groupBy("row").agg(F.array_sort(F.collect_list(_slot(F.col("slot"), lo, hi))).alias("slots"))
    negatives = _walked(points, members.join(ranges, "row"), lists, NEGATIVES, alike=False)
    if negatives is None:
        return spark.createDataFrame([], result)
    ids = members.select("row", F.col("vec_id").alias("anchor_id"))
    return (
        negatives.select("row", "slot", F.posexplode("best").alias("at", "n")).join(scored, ["row", "slot"]).join(ids, "row")
        .select("anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("n.vec_id").alias("negative_id"), "positive_score", (-F.col("n.far")).alias("negative_score")))
