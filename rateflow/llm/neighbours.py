"""Nearest neighbours by cross-polytope hashing (Andoni et al., 2015), reranked exactly.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a unit
vector; its nearest signed axis among the first 64 coordinates is its hash. Two hashes make a
bucket, in each of ``tables`` tables. A query ranks all buckets of all tables by the sum of its
own two coordinates on their axes, and probes those above a threshold. For random rotations the
chance that a row at a given cosine lies in a probed bucket follows from the threshold alone;
``Curve`` measures it once on random vectors. So the probes follow the data, at every size alike:

1. A first round probes what would hold 1.5 % of unrelated rows. Rows found, weighted by one over
   their chance of being found, tell how near the ``k``-th nearest is.
2. A second round probes the buckets between that threshold and the one at which a row as near
   as that is found with probability ``recall``. A query whose first round holds fewer than ``k``
   rows probes everything.

For the largest inner product, vectors are dealt by the range of their norm (at most 41: powers
of 1.2, all shorter ones in the last). Within a range the angle follows the product; a range
whose longest vector cannot reach the products already found is left out.

Rows are dealt evenly to blocks of about ``block``, and queries to parts of as many. A task holds
one block with the tables of its rows and one part, so no bucket is ever a group of its own.
Pairs are scored once, in double precision, and only a block's ``k`` best go on.

Hot groups: equal vectors are one class. It is hashed and scored once and carries its ``k`` + 1
smallest ids, limited in the map step, before the shuffle. Classes are told by a 64-bit hash.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have
another length than the most common one (the smaller on ties) take no part; a null id takes
no part; rows that repeat an id and vector count once; ties go to the smaller id; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm.common import written

#: Norms of one range differ by this factor at most, but for the last range.
STEP = 1.2
RANGES = 41
#: Coordinates of a rotation that serve as axes.
AXES = 64
#: Part of unrelated rows that the first round scores.
FIRST = 0.015


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (length a power of two)."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def rotations(x: np.ndarray, tables: int, seed: int = 11):
    """Each table's pseudo-rotation of the rows, up to scale."""
    rng = np.random.default_rng(seed)
    signs = rng.integers(0, 2, (tables, 3, x.shape[1])) * 2.0 - 1
    for table in signs:
        y = x
        for s in table:
            y = hadamard(y * s)
        yield y


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, padded to a power of two."""
    n, dims = vectors.shape
    x = np.zeros((n, 1 << (dims - 1).bit_length()))
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # its squares are in range
    x[:, :dims] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return x


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _turned(x: np.ndarray, tables: int):
    """Each table's two hashes of unit vectors: the rows' coordinates on all signed axes."""
    ys = (np.concatenate([y[:, :AXES], -y[:, :AXES]], axis=1) / x.shape[1] ** 1.5 for y in rotations(x, 2 * tables))
    return zip(ys, ys, strict=True)


class Curve:
    """How far a query must probe for a row at a given cosine, measured on random vectors."""

    def __init__(self, dims: int, tables: int, recall: float, pairs: int = 1000):
        rng = np.random.default_rng(12)
        a, g = rng.normal(size=(2, pairs, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        g -= (g * a).sum(axis=1, keepdims=True) * a
        g /= np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-9)
        query = list(_turned(_unit(a), tables))
        at = np.arange(pairs)
        self.cosines = np.linspace(0, 0.95, 20)
        #: the best bucket sum that leads to the row, by cosine and pair
        best = []
        for c in self.cosines:
            row = _turned(_unit(c * a + np.sqrt(1 - c * c) * g + 1e-12), tables)
            best.append(np.max([q[0][at, r[0].argmax(axis=1)] + q[1][at, r[1].argmax(axis=1)] for q, r in zip(query, row, strict=True)], axis=0))
        best = np.sort(np.array(best), axis=1)
        self.first = float(np.quantile(best[0], 1 - FIRST))
        self.found = 1 - np.array([np.searchsorted(b, self.first, "right") for b in best]) / pairs
        self.thresholds = np.quantile(best, 1 - recall, axis=1)

    def weight(self, cosine: np.ndarray) -> np.ndarray:
        """One over the chance that the first round finds a row."""
        return 1 / np.maximum(np.interp(cosine, self.cosines, self.found), FIRST)

    def threshold(self, cosine: float) -> float:
        """Bucket sum down to which a query probes for rows of this cosine: all, if they are unrelated."""
        return float(np.interp(cosine, self.cosines, self.thresholds)) if cosine > 0 else -np.inf


@lru_cache(4)
def curve_of(dims: int, tables: int, recall: float) -> Curve:
    return Curve(dims, tables, recall)


def _members(hit: np.ndarray, start: np.ndarray, count: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Places (query * rows + row) of the rows in each query's ``hit`` buckets."""
    query, bucket = np.nonzero(hit)
    n = count[bucket]
    skipped = np.cumsum(n) - n
    rows = order[np.repeat(start[bucket] - skipped, n) + np.arange(n.sum())]
    return np.repeat(query, n) * len(order) + rows


def _best_of_block(k: int, tables: int, curve: Curve):
    """The ``k`` best classes of one block for each query, of those in buckets whose sum is above
    the query's ``lower`` and was not above ``upper``. The first of a query's rows tells how many were scored."""
    schema = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                        ("score", pa.float64()), ("weight", pa.float64()), ("scored", pa.int64())])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        x, first, cls, n_ids = _matrix(rows["embedding"]), *(rows[c].to_numpy() for c in ("first_id", "class", "n_ids"))
        index = []
        for y, z in _turned(_unit(x), tables):
            bucket = y.argmax(axis=1) * z.shape[1] + z.argmax(axis=1)
            present, count = np.unique(bucket, return_counts=True)
            index.append((present // z.shape[1], present % z.shape[1], np.cumsum(count) - count, count, np.argsort(bucket, kind="stable")))
        q, names = _matrix(queries["embedding"]), queries["query"].to_numpy()
        lower, upper = queries["lower"].to_numpy(), queries["upper"].to_numpy()
        norms = np.linalg.norm(x, axis=1)
        out, step = [], max(1, 2**21 // len(x))
        for lo in range(0, len(q), step):
            part = q[lo:lo + step]
            every = np.isneginf(lower[lo:lo + step])
            least, most = np.where(every, np.inf, lower[lo:lo + step])[:, None], upper[lo:lo + step, None]
            wanted, done = np.zeros((2, len(part), len(x)), bool)
            for (y, z), (one, two, start, count, order) in zip(_turned(_unit(part), tables), index, strict=True):
                sums = y[:, one] + z[:, two]
                wanted.reshape(-1)[_members(sums > least, start, count, order)] = True
                if np.isfinite(most).any():
                    done.reshape(-1)[_members(sums > most, start, count, order)] = True
            wanted[every] = True
            which, near = np.nonzero(wanted & ~done)
            # each pair by itself, so that a score does not depend on the block around it
            score = np.empty(len(which))
            for i in range(0, len(which), 2**15):
                score[i:i + 2**15] = np.einsum("ij,ij->i", part[which[i:i + 2**15]], x[near[i:i + 2**15]])
            scored = np.bincount(which, minlength=len(part))
            best = np.lexsort((first[near], -score, which))
            rank = np.arange(len(best)) - np.repeat(np.cumsum(scored) - scored, scored)
            keep, rank = best[rank < k], rank[rank < k]
            which, near, score = which[keep], near[keep], score[keep]
            cosine = score / np.linalg.norm(part, axis=1)[which] / norms[near]
            out.append(pa.table([names[lo + which], cls[near], first[near], n_ids[near], score, curve.weight(cosine), np.where(rank == 0, scored[which], 0)], schema=schema))
        return pa.concat_tables(out)

    return run


def _second_round(k: int, curve: Curve, ranges: list[tuple[int, float]]):
    """Map step: the ranges of norms (with the logarithm of their greatest) in which a query must
    probe on, and how far."""
    names = ["query", "embedding", "range", "lower", "upper"]

    def run(batches):
        for batch in batches:
            query, embedding, log_norm, best = (batch.column(i) for i in range(4))
            at, places, lowers = [], [], []
            for i, (norm, found) in enumerate(zip(log_norm.to_pylist(), best.to_pylist(), strict=True)):
                ids = weight = 0.0
                surely = likely = -np.inf  # product of the k-th: at least, and as estimated
                for f in found or ():
                    ids, weight = ids + f["n_ids"], weight + f["n_ids"] * f["weight"]
                    if weight >= k and likely == -np.inf:
                        likely = -f["far"]
                    if ids >= k:
                        surely = -f["far"]
                        break
                for place, longest in ranges:
                    reach = norm + longest + 1e-9
                    if surely > 0 and np.log(surely) > reach:
                        continue
                    enough = surely > -np.inf and likely > 0
                    lower = curve.threshold(min(1.0, float(np.exp(np.log(likely) - reach)))) if enough else -np.inf
                    if lower < curve.first:
                        at.append(i)
                        places.append(place)
                        lowers.append(lower)
            yield pa.RecordBatch.from_arrays([
                query.take(pa.array(at, pa.int64())), embedding.take(pa.array(at, pa.int64())), pa.array(places, pa.int32()),
                pa.array(lowers, pa.float64()), pa.array([curve.first] * len(at), pa.float64())], names=names)

    return run


def _usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embedding.isNotNull() & ~bad & F.exists(embedding, lambda v: v != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = 16, recall: float = 0.88, block: int = 16384) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (inner product) of the ``k`` rows
    nearest to each row of ``vectors`` (vec_id, embedding) for which ``is_query`` holds, and
    ``n_scored``, the number of classes scored for the query. A row as near as the ``k``-th is found
    with probability ``recall``, a nearer one more likely."""
    wide = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("embedding"), is_query.alias("asked")).filter(
        F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not length:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, n_scored long")
    dims = length[0].n
    rows = rows.filter(F.size("embedding") == dims).withColumn("class", F.xxhash64("embedding"))
    most = F.array_max(F.transform("embedding", F.abs))  # squares of scaled values are in range
    log_norm = F.log(most) + F.log(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + (v / most) * (v / most))) / 2

    # classes of equal vectors with their k + 1 smallest ids: a query's own row may be among them
    smallest = Window.partitionBy("class").orderBy("vec_id")
    ids = (
        rows.select("class", "vec_id").distinct().withColumn("row", F.row_number().over(smallest)).filter(F.col("row") <= k + 1)
        .groupBy("class").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    alike = rows.groupBy("class").agg(F.first("embedding").alias("embedding"), F.max(F.coalesce("asked", F.lit(False))).alias("asked"))
    classes = written(alike.join(ids, "class").withColumn("log_norm", log_norm), "classes")
    greatest = classes.agg(F.max("log_norm").alias("x")).collect()[0].x
    # half a step above the greatest: vectors of one length, up to rounding, are one range
    place = F.least(F.floor((F.lit(greatest) - F.col("log_norm")) / float(np.log(STEP)) + 0.5), F.lit(RANGES - 1)).cast("int")
    ranges = classes.groupBy(place.alias("range")).agg(F.count(F.lit(1)).alias("n"), F.max("log_norm").alias("longest")).collect()  # at most RANGES
    n_queries = classes.filter("asked").count()
    parts = max(1, -(-n_queries // block))
    blocks = F.element_at(F.create_map(*[F.lit(x) for r in ranges for x in (r.range, -(-r.n // block))]), F.col("range"))
    part = F.pmod(F.hash(F.lit(1), F.col("query")), F.lit(parts)).alias("part")

    points = classes.select(
        "class", "embedding", F.col("ids")[0].alias("first_id"), F.size("ids").alias("n_ids"), place.alias("range")
    ).withColumn("block", F.pmod(F.hash("class"), blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = classes.filter("asked").select(F.col("class").alias("query"), "embedding", "log_norm")

    curve = curve_of(dims, tables, recall)

    def best(probes: DataFrame, name: str) -> DataFrame:
        """The ``k`` + 1 best classes of each of ``probes`` (query, embedding, range, lower, upper)."""
        asked = probes.select("query", "embedding", "lower", "upper", "range", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), part)
        return written(
            asked.groupBy("range", "block", "part").cogroup(points.groupBy("range", "block", "part"))
            .applyInArrow(_best_of_block(k + 1, tables, curve),
                          "query long, class long, first_id long, n_ids int, score double, weight double, scored long"), name)

    nearer = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")

    def merged(found: DataFrame) -> DataFrame:
        entry = F.struct((-F.col("score")).alias("far"), "first_id", "class", "n_ids", "weight")
        return found.withColumn("row", F.row_number().over(nearer)).filter(F.col("row") <= k + 1).groupBy("query").agg(
            F.array_sort(F.collect_list(entry)).alias("best"))

    everywhere = F.array(*[F.lit(r.range) for r in ranges])
    one = best(queries.select("query", "embedding", F.explode(everywhere).alias("range"), F.lit(curve.first).alias("lower"), F.lit(float("inf")).alias("upper")), "first")
    on = queries.join(merged(one), "query", "left").select("query", "embedding", "log_norm", "best").mapInArrow(
        _second_round(k + 1, curve, [(r.range, r.longest) for r in ranges]),
        "query long, embedding array<double>, range int, lower double, upper double")
    two = best(on, "second")
    found = one.union(two)

    listed = merged(found).select("query", F.explode("best").alias("b")).join(
        classes.select(F.col("class").alias("c"), "ids"), F.col("b.class") == F.col("c"))
    answer = listed.select("query", (-F.col("b.far")).alias("score"), F.explode("ids").alias("vec_id")).groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k + 1).alias("found"))
    own = F.filter("found", lambda f: f["vec_id"] != F.col("query_id"))
    effort = found.groupBy("query").agg(F.sum("scored").alias("n_scored"))
    asked = rows.filter("asked").select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")).distinct()
    return (
        asked.join(answer, "query").join(effort, "query").select("query_id", "n_scored", F.posexplode(F.slice(own, 1, k)).alias("at", "f"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.far")).alias("score"), "n_scored")
    )
