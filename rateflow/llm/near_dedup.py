"""Near-duplicate groups by ProbMinHash (Ertl, 2020), banding and exact verification.

A document is the weighted set of its shingles of five words. Each shingle is a Poisson
process whose rate is its weight; every arrival falls into a random register, which keeps the
shingle that arrives first. A shingle is dropped as soon as its next arrival comes after every
register's first. Two documents agree in a register with the probability Jaccard of their
weights. Documents that agree in a whole band of registers share a bucket, and candidates are
verified with their exact probability Jaccard of at least ``threshold``.

Without all pairs: equal word sequences are one node (64-bit hash) first. In small buckets (8
nodes) all pairs are verified. In larger ones all nodes are compared with two leaders, which joins most
nodes of a group of copies.

What that leaves is verified without a cap: all nodes of larger buckets that still hold several components
meet those of other components with which they share a shingle of their prefix (their rarest shingles, of
more than 1 - ``threshold`` of their weight). Weights in common sum up to the probability Jaccard at
least, so two documents at the threshold share such a shingle: no pair is lost by that, and texts that collide
by a common boilerplate hardly meet. Nodes that hang together by such shingles are a family; a family is cut
into blocks of a bounded number of shingles, and each task puts one block against another: the
weights are sent once a block, pairs are bounded by their weights in common before they are compared, and pairs of
one component (also of one that the task has just found) are passed over. A link is missed only if its
ends share no band.

Groups are the connected components of the verified links.

Defined cases: null text is empty; texts without words are alike only if they are equal;
texts of fewer than five words are one shingle; rows that repeat a document are copies; an
empty table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateflow.llm.common import sliced, written
from rateflow.llm.components import components
from rateflow.llm.shingles import ROUNDING, probability_jaccard, shingles, word_hashes

BANDS, ROWS = 20, 5
LEADERS = 2
#: Nodes of a bucket up to which all of them meet.
COMPLETE = 8
#: Shingles of the nodes in a block of a family (a single node may have more).
BLOCK = 1 << 18


def _mix(z: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator."""
    # The published constants.
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signature (one row of shingle hashes) of each weighted set; 0 where empty.
    At most 2048 registers: 11 bits of each draw choose one."""
    first = np.full((len(sets), registers), np.inf)
    owner = np.zeros((len(sets), registers), np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    if not len(doc):
        return owner
    item = np.concatenate([s[0] for s in sets])
    rate = np.concatenate([s[1] for s in sets]).astype(np.float64)
    time, draw = np.zeros(len(doc)), 0
    first_flat, owner_flat = first.reshape(-1), owner.reshape(-1)
    while len(doc):
        draw += 1
        z = _mix(item + np.uint64(draw * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log1p(-((z >> np.uint64(11)) * 2.0**-53)) / rate
        at = doc * registers + (((z & np.uint64(0x7FF)) * np.uint64(registers)) >> np.uint64(11)).astype(np.int64)
        np.minimum.at(first_flat, at, time)
        won = first_flat[at] == time
        owner_flat[at[won]] = item[won]
        # the latest first arrival of each document that goes on
        some = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        latest = np.repeat(first[doc[some]].max(axis=1), np.diff(np.append(some, len(doc))))
        alive = time < latest
        doc, item, rate, time = doc[alive], item[alive], rate[alive], time[alive]
    return owner


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A key per band (with the band's number in it) of each signature."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), BANDS)).copy()
    for i in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, i::ROWS][:, :BANDS])
    return key.view(np.int64)


def _node(text: str, words: np.ndarray) -> int:
    """64-bit identity of a word sequence (of the text, if it has no words)."""
    return xxhash.xxh3_64_intdigest(words.tobytes() if len(words) else text, seed=not len(words)) - (1 << 63)


def _sign(batches):
    for batch in sliced(batches, 500):
        rows = batch.column(1).to_pylist()
        words = [word_hashes(t) for t in rows]
        nodes = [_node(t, w) for t, w in zip(rows, words, strict=True)]
        keys = band_keys(signatures([shingles(w) for w in words]))
        bands = [k if len(w) else [] for k, w in zip(keys.tolist(), words, strict=True)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "node", "bands"])


def _with_node(batches):
    for batch in sliced(batches):
        nodes = [_node(t, word_hashes(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(0)], names=["node", "text"])


@lru_cache(64)
def _weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return shingles(word_hashes(text))


def _weights(batches):
    """Shingles of each text and how often each occurs, packed."""
    for batch in sliced(batches):
        sets = [shingles(word_hashes(t)) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([h.tobytes() for h, _ in sets], pa.binary()), pa.array([w.astype(np.int64).tobytes() for _, w in sets], pa.binary()),
            pa.array([len(h) for h, _ in sets], pa.int32())], names=["node", "label", "hashes", "counts", "size"])


def _shares(batches):
    """Every shingle of each node with its share of the node's weight."""
    for batch in sliced(batches, 500):
        rows = [(np.frombuffer(h, np.int64), np.frombuffer(w, np.int64)) for h, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        sizes = [len(h) for h, _ in rows]
        yield pa.RecordBatch.from_arrays([
            *[pa.array(np.repeat(batch.column(c).to_numpy(), sizes)) for c in (0, 1)],
            pa.array(np.concatenate([h for h, _ in rows])), pa.array(np.concatenate([w / max(w.sum(), 1) for _, w in rows]))],
            names=["node", "label", "shingle", "part"])


def _verify(threshold: float):
    def run(batches):
        for batch in sliced(batches):
            same = [probability_jaccard(_weighted(x), _weighted(y), threshold) >= threshold - ROUNDING for x, y in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    x = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    y = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # a given count: few bytes, but much work, would be merged into one task
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b").repartition(tasks, "a").sortWithinPartitions("a")
    return both.mapInArrow(_verify(threshold), "a long, b long, same boolean")


def _chosen(members: DataFrame) -> DataFrame:
    """The nodes of each bucket that meet all others: every one if they are at most ``COMPLETE``,
    else ``LEADERS`` of them by a hash. The hash is the same in every bucket, so that the many buckets of a
    large group have few leaders between them, and a node of the group meets each of these once."""
    by_hash = Window.partitionBy("bucket").orderBy(F.xxhash64("node"), "node")
    some = members.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= COMPLETE + 1)
    some = some.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bucket")))  # COMPLETE + 1 rows at most
    return some.filter((F.col("n") <= COMPLETE) | (F.col("place") <= LEADERS)).select("bucket", F.col("node").alias("other"))


def _links(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs (a < b) of each bucket's nodes with its chosen ones."""
    met = members.join(_chosen(members), "bucket").filter(F.col("node") != F.col("other"))
    pairs = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    return written(_verified(pairs, texts, threshold), "pairs").filter("same").select("a", "b")


def _met(threshold: float):
    """One block of a family against another (or itself): links of nodes of different components."""

    def run(rows: pa.Table) -> pa.Table:
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        block, node, label = (rows[c].to_numpy() for c in ("block", "node", "label"))
        sets = [(np.frombuffer(h, np.uint64), np.frombuffer(w, np.int64)) for h, w in zip(rows["hashes"].to_pylist(), rows["counts"].to_pylist(), strict=True)]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        # places of each shingle on the left, with its share of the node's weight
        hashes = np.concatenate([sets[k][0] for k in left]) if len(left) else np.empty(0, np.uint64)
        shares = np.concatenate([sets[k][1] / sets[k][1].sum() for k in left]) if len(left) else np.empty(0)
        owner = np.repeat(np.arange(len(left)), [len(sets[k][0]) for k in left])
        order = np.argsort(hashes, kind="stable")
        hashes, shares, owner = hashes[order], shares[order], owner[order]
        top = {int(x): int(x) for x in np.unique(label)}

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        found = []
        for k in right:
            mine, count = sets[k]
            lo, hi = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(owner[at], np.minimum(shares[at], np.repeat(count / count.sum(), n)), minlength=len(left))
            for x in np.flatnonzero(common >= threshold - ROUNDING):
                other = left[x]
                if (i == j and other >= k) or root(int(label[other])) == root(int(label[k])):
                    continue
                if probability_jaccard(sets[other], sets[k], threshold) >= threshold - ROUNDING:
                    found.append((min(node[other], node[k]), max(node[other], node[k])))
                    top[root(int(label[other]))] = root(int(label[k]))
        return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return run


def _rest(members: DataFrame, links: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links that join components of ``links`` further: of nodes, in buckets larger than ``COMPLETE`` that hold
    several components, that share a shingle of their prefixes."""
    labels = written(components(links), "labels")
    placed = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).filter(
        (F.col("n") > COMPLETE) & (F.col("low") != F.col("high"))).select("bucket")
    nodes = written(placed.join(mixed, "bucket").select("node", "label").distinct(), "rest-nodes")
    sets = written(texts.join(nodes, "node").select("node", "label", "text").mapInArrow(
        _weights, "node long, label long, hashes binary, counts binary, size int"), "rest-sets")
    parts = sets.select("node", "label", "hashes", "counts").mapInArrow(_shares, "node long, label long, shingle long, part double")
    # any fixed order of shingles is right; with the rare ones first few nodes meet
    seen = parts.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("node").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    prefix = parts.join(seen, "shingle").withColumn("before", F.coalesce(F.sum("part").over(before), F.lit(0.0)))
    # a margin for the sums' rounding
    prefix = written(prefix.filter((F.col("before") <= 1 - threshold + ROUNDING) & (F.col("n") > 1)).select("shingle", "node", "label"), "prefixes")
    several = prefix.groupBy("shingle").agg(F.min("node").alias("first"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    together = prefix.join(several.select("shingle", "first"), "shingle").filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    families = components(together.distinct()).select("node", F.col("label").alias("family"))
    sized = written(sets.join(families, "node"), "families")
    blocks = sized.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks"))
    dealt = sized.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = dealt.select("family", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "label", "hashes", "counts")
    return written(met.groupBy("family", "i", "j").applyInArrow(_met(threshold), "a long, b long"), "rest")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``node`` (equal for equal word sequences),
    ``group_id`` (the least doc_id of its group) and ``n_links`` (links of its node that were verified to
    find the groups)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    signed = written(texts.mapInArrow(_sign, "doc_id long, node long, bands array<long>"), "signatures")
    bands = signed.dropDuplicates(["node"]).select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").count().filter("count > 1").select("band")
    members = written(bands.join(shared, "band").select(F.col("band").alias("bucket"), "node"), "members")
    needed = members.select("node").distinct()
    some = written(
        texts.select("text").mapInArrow(_with_node, "node long, text string")
        .join(needed, "node", "left_semi").dropDuplicates(["node"]), "texts")
    direct = _links(members, some, threshold)
    links = written(direct.unionByName(_rest(members, direct, some, threshold)).distinct(), "links")
    labels = components(links)
    counts = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    placed = (
        signed.select("doc_id", "node").join(labels, "node", "left").join(counts, "node", "left")
        .select("doc_id", "node", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )
    least = placed.groupBy("label").agg(F.min("doc_id").alias("group_id"))
    return placed.join(least, "label").select("doc_id", "node", "group_id", "n_links")
