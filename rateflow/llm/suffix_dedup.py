"""Exact substring dedup: every byte in a window of ``depth`` bytes that also starts earlier
is removed (suffixes ordered to a limited depth by most-significant-digit radix passes).

Two suffixes matter to each other only if their first ``depth`` bytes agree, so suffixes are
never sorted beyond that depth. The digits of the radix sort, most significant first:

1. *Anchor digit.* The ``GRAM``-byte string in the window with the least hash (leftmost on
   ties). It depends on the window's bytes alone, so equal windows have equal anchors at
   equal offsets, and neighbouring windows share theirs: about one row per 35 bytes is
   shuffled, not one per byte. Anchors found once end the sort for all their windows.
2. *Byte digits.* The windows of an anchor found more often are ordered by 8-byte digits,
   dropping a group as soon as it has one member. What is left at ``depth`` are exactly the
   repeated windows; all but the earliest of each group are removed. Bytes are compared, not
   hashes, so the result is exact.

Hot groups: a map batch sends each anchor once with its members' places, and each distinct
context once (copies later in the batch are known to be repeated). An anchor found more than
2048 times, such as the edge of a passage shared by a third of all documents, is dealt out in
parts of eight windows, by the bytes that these have in common, and beyond 131,072 times by
each single window, so that no task gets all of its rows.

Order: smaller ``doc_id`` first (null first), then the document's 64-bit key, then start.
Defined cases: null text is empty; documents shorter than ``depth`` are kept whole; rows that
repeat doc_id and text are one document, which each of them returns; an empty table gives an
empty result; ``cut_repeats`` carries all columns along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from rateflow.llm.common import doc_key, sliced

GRAM = 32
#: Occurrences above which an anchor's windows are dealt out in parts, and by how many windows a
#: part has (0: not dealt out).
HOT, WIDTHS = (2048, 1 << 17), (0, 8, 1)
#: Window starts worked on at once within one document.
SEGMENT = 1 << 20
_POS = np.uint64((1 << 24) - 1)
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = [np.uint64(int(x) | 1) for x in np.random.default_rng(7).integers(1 << 40, 1 << 62, 6)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes from each position, by doubling."""
    h = _BYTE[data]
    step, i = 1, 0
    while step < GRAM:
        h = h[:-step] * _MULT[i] + h[step:]
        step, i = step * 2, i + 1
    h ^= h >> np.uint64(31)
    h *= _MULT[5]
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a document's windows: position, hash, first and last window start."""
    parts = []
    width = depth - GRAM + 1
    for lo in range(0, max(0, len(data) - depth + 1), SEGMENT):
        h = gram_hashes(data[lo:lo + SEGMENT + depth - 1])
        v = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            v, size = np.minimum(v[:-size], v[size:]), size * 2
        if size < width:
            v = np.minimum(v[:size - width], v[width - size:])
        at = (v & _POS).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        end = np.concatenate((start[1:], [len(at)])) - 1
        parts.append((at[start] + lo, h[at[start]], start + lo, end + lo))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """Each text's bytes, without copies."""
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    for i in range(len(column)):
        yield data[ends[i]:ends[i + 1]]


_PLACE = np.dtype([("k", "<i8"), ("a", "<i8")])


def _anchor_rows(depth: int):
    """Map step: one row per anchor hash and batch, with the places of all its members."""
    schema = pa.schema([("h", pa.int64()), ("k", pa.int64()), ("a", pa.int64()), ("more", pa.binary())])

    def run(batches):
        for batch in sliced(batches, 2000):
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            hs, ks, at = [], [], []
            for key, data in zip(keys, _texts(batch.column(1)), strict=True):
                if len(data) >= depth:
                    a, h, _, _ = anchors(data, depth)
                    hs.append(h.view(np.int64))
                    at.append(a)
                    ks.append(np.full(len(a), key, np.int64))
            if not hs:
                continue
            h, k, a = np.concatenate(hs), np.concatenate(ks), np.concatenate(at)
            order = np.argsort(h, kind="stable")
            h, place = h[order], np.empty(len(h), _PLACE)
            place["k"], place["a"] = k[order], a[order]
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            ends = np.append(first[1:], len(h))
            more: list[bytes | None] = [None] * len(first)
            for i in np.flatnonzero(ends - first > 1):
                more[i] = place[first[i] + 1:ends[i]].tobytes()
            yield pa.record_batch([h[first], place["k"][first], place["a"][first], pa.array(more, pa.binary())], schema=schema)

    return run


def _repeated_places(hot: tuple[int, int]):
    """Reduce step over rows sorted by hash: the places of anchors found more than once, as
    ``4 * position + heat``, heat being how many of the limits ``hot`` are passed."""
    schema = pa.schema([("k", pa.int64()), ("code", pa.int64())])

    def places(h, k, a, more):
        bounds = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.append(bounds, len(h)))
        extra = np.zeros(len(h), np.int64)
        full = np.flatnonzero(more.is_valid().to_numpy(zero_copy_only=False))
        got = {int(i): np.frombuffer(more[int(i)].as_py(), _PLACE) for i in full}
        for i, x in got.items():
            extra[i] = len(x)
        total = np.repeat(np.add.reduceat(extra, bounds) + size, size)
        heat = (total > hot[0]).astype(np.int64) + (total > hot[1])
        keep = total > 1
        outs = [(k[keep], a[keep] * 4 + heat[keep])]
        outs += [(x["k"], x["a"] * 4 + heat[i]) for i, x in got.items()]
        return pa.record_batch([np.concatenate([o[0] for o in outs]), np.concatenate([o[1] for o in outs])], schema=schema)

    def run(batches):
        held = None
        for batch in batches:
            t = pa.table(batch.columns, names=["h", "k", "a", "more"])
            t = pa.concat_tables([held, t]) if held is not None else t
            h = t["h"].to_numpy()
            if not len(h):
                continue
            cut = int(np.searchsorted(h, h[-1]))  # the last hash may go on in the next batch
            held = t.slice(cut)
            if cut:
                done = t.slice(0, cut)
                yield places(h[:cut], done["k"].to_numpy(), done["a"].to_numpy(), done["more"].combine_chunks())
        if held is not None and len(held):
            yield places(held["h"].to_numpy(), held["k"].to_numpy(), held["a"].to_numpy(), held["more"].combine_chunks())

    return run


_CONTEXT = pa.schema([("key", pa.int64()), ("reach", pa.int32()), ("context", pa.binary()), ("doc_id", pa.int64()), ("k", pa.int64()), ("start", pa.int64()), ("known", pa.int64())])


def _parts(raw: bytes, depth: int, at: int, lo: int, hi: int, hash_: int, width: int):
    """The windows from ``lo`` to ``hi`` of the anchor at ``at``, as (shuffle key, first, last).

    ``width`` 0: all under the anchor's hash. Else in parts of ``width`` offsets from the anchor,
    keyed by the bytes that all windows of the part have in common."""
    if not width:
        yield hash_, lo, hi
        return
    for part in range((at - hi) // width, (at - lo) // width + 1):
        near, far = at - part * width, at - part * width - width + 1
        key = xxhash.xxh64_intdigest(raw[near:far + depth], seed=part) - (1 << 63)
        yield key, max(lo, far), min(hi, near)


def _contexts(depth: int, id_at: int, text_at: int):
    """Map step over (_k, _row, codes): for each repeated anchor the bytes of its windows, dealt by
    ``WIDTHS``. ``id_at`` and ``text_at`` are the places of doc_id and text in ``_row``.

    A context that the batch has already (in the document order) is known to be repeated:
    such spans are merged within their document, and sent without bytes (``known`` is the
    length) under their document's key."""

    def run(batches):
        for batch in batches:
            row, keys, codes = batch.column(1), batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            docs = pc.struct_field(row, id_at).cast(pa.int64())
            ids = np.array([-(1 << 63) if x is None else x for x in docs.to_pylist()], np.int64)
            texts = list(_texts(pc.struct_field(row, text_at)))
            seen: dict[tuple[int, int, bytes], tuple[int, int]] = {}
            out: list[tuple] = []
            for i in np.lexsort((keys, ids)):
                data, code = texts[i], np.sort(np.asarray(codes[int(i)].values))
                a, h, first, last = anchors(data, depth)
                found = np.searchsorted(a, code >> 2)
                raw, key, doc = data.tobytes(), int(keys[i]), int(ids[i])
                known: list[list[int]] = []
                for j, heat in zip(found.tolist(), (code & 3).tolist(), strict=True):
                    at, hash_ = int(a[j]), int(h[j].view(np.int64))
                    spans = _parts(raw, depth, at, int(first[j]), int(last[j]), hash_, WIDTHS[heat])
                    for shared, p, q in sorted(spans, key=lambda s: s[1]):
                        context = raw[p:q + depth]
                        if seen.setdefault((shared, at - p, context), (key, p)) == (key, p):
                            out.append((shared, at - p, context, doc, key, p, 0))
                        elif known and p <= known[-1][1]:
                            known[-1][1] = max(known[-1][1], q + depth)
                        else:
                            known.append([p, q + depth])
                out.extend((key, 0, b"", doc, key, s, e - s) for s, e in known)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _CONTEXT.types, strict=True)], schema=_CONTEXT)

    return run


def _radix_repeats(rows: list[tuple], depth: int) -> Iterator[tuple[int, int, int]]:
    """Repeated spans (k, start, end) among whole groups of (key, reach, context, doc_id, k,
    start)."""
    # document order of the anchors; repeated rows of a document give the same place twice
    rows = sorted(set(rows), key=lambda r: (r[3], r[4], r[5] + r[1]))
    seen: set[tuple] = set()
    left: list[tuple] = []
    for r in rows:
        same = (r[0], r[1], r[2])
        if same in seen:  # equal contexts: the first has the same windows earlier
            yield r[4], r[5], r[5] + len(r[2])
        else:
            seen.add(same)
            left.append(r)
    members: dict[int, int] = {}
    for r in left:
        members[r[0]] = members.get(r[0], 0) + 1
    left = [r for r in left if members[r[0]] > 1]
    if not left:
        return
    buffer = np.frombuffer(b"".join(r[2] for r in left) + bytes(8), np.uint8).astype(np.uint64)
    word = buffer[:-7].copy()
    for i in range(1, 8):
        word = (word << np.uint64(8)) | buffer[i:len(buffer) - 7 + i]
    sizes = np.array([len(r[2]) for r in left], np.int64)
    windows = sizes - depth + 1
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(left)), windows)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begin[owner] + index
    reach = np.array([r[1] for r in left], np.int64)[owner] - index
    _, group = np.unique(np.array([r[0] for r in left], np.int64), return_inverse=True)
    label = group[owner] * (depth + 1) + reach
    alive = np.arange(len(owner))
    for digit in range(0, depth, 8):
        value = word[at[alive] + digit]
        if digit + 8 > depth:
            value = value >> np.uint64(8 * (digit + 8 - depth))
        order = np.lexsort((value, label))  # stable: document order inside a group
        alive, label, value = alive[order], label[order], value[order]
        new = np.concatenate(([True], (label[1:] != label[:-1]) | (value[1:] != value[:-1])))
        label = np.cumsum(new)
        size = np.bincount(label)
        many = size[label] > 1
        alive, label = alive[many], label[many]
        if not len(alive):
            return
    later = np.concatenate(([False], label[1:] == label[:-1]))
    hit = np.sort(alive[later])
    own, pos = owner[hit], index[hit]
    run = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (pos[1:] != pos[:-1] + 1))))
    for i, j in zip(run, np.append(run[1:], len(hit)) - 1, strict=True):
        r = left[own[i]]
        yield r[4], r[5] + int(pos[i]), r[5] + int(pos[j]) + depth


def _repeated_spans(depth: int, rows_at_once: int = 20_000):
    """Reduce step over rows sorted by key: radix passes on a few whole groups at a time."""
    schema = pa.schema([("k", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def send(spans):
        spans = list(spans)
        if spans:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*spans, strict=True)], schema=schema)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            direct = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[6]:
                    direct.append((r[4], r[5], r[5] + r[6]))
                    continue
                if len(held) >= rows_at_once and held[-1][0] != r[0]:
                    yield from send(_radix_repeats(held, depth))
                    held = []
                held.append(r[:6])
            yield from send(direct)
        yield from send(_radix_repeats(held, depth))

    return run


def _cut(text_at: int):
    """Map step over (_k, _row, spans): merge each row's spans and take them out of its text, the
    ``text_at``-th field of ``_row``."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in sliced(batches):
            n, spans, kept = [], [], []
            for data, found in zip(_texts(pc.struct_field(batch.column(1), text_at)), batch.column(2), strict=True):
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in (found.as_py() or [])):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                raw, at, parts = data.tobytes(), 0, []
                for s, e in merged:
                    parts.append(raw[at:s])
                    at = e
                n.append(len(raw))
                spans.append([{"start": s, "end": e} for s, e in merged])
                kept.append(b"".join([*parts, raw[at:]]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=["_k", "_row", "n_bytes", "spans", "kept"])

    return run


def cut_repeats(docs: DataFrame, depth: int = 100, hot: tuple[int, int] = HOT) -> DataFrame:
    """One row per row of ``docs``: ``_k`` (``doc_key``), ``_row`` (all of its columns), ``n_bytes``,
    ``spans`` (the maximal removed byte runs, in order) and ``kept`` (the bytes that stay)."""
    base = docs.select(doc_key().alias("k"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = (
        base.select("k", "text").mapInArrow(_anchor_rows(depth), "h long, k long, a long, more binary")
        .repartition("h").sortWithinPartitions("h")
        .mapInArrow(_repeated_places(hot), "k long, code long")
        .groupBy("k").agg(F.collect_set("code").alias("codes"))
    )
    # both joins take whole rows by their key, so the texts are shuffled once for the two
    rows = docs.select(doc_key().alias("_k"), F.struct("*").alias("_row"))
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    spans = (
        rows.join(found, F.col("_k") == F.col("k")).select("_k", "_row", "codes")
        .mapInArrow(_contexts(depth, id_at, text_at), "key long, reach int, context binary, doc_id long, k long, start long, known long")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_repeated_spans(depth), "k long, start long, end long")
        .groupBy("k").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )
    joined = rows.join(spans, F.col("_k") == F.col("k"), "left").select("_k", "_row", "spans")
    out = StructType([*rows.schema.fields]).add("n_bytes", "long").add("spans", ArrayType(StructType().add("start", LongType()).add("end", LongType()))).add("kept", "binary")
    return joined.mapInArrow(_cut(text_at), out)


def repeated_spans(docs: DataFrame, depth: int = 100, hot: tuple[int, int] = HOT) -> DataFrame:
    """``cut_repeats`` with ``doc_id`` in the place of the row's columns."""
    cut = cut_repeats(docs.select("doc_id", "text"), depth, hot)
    return cut.select("_k", F.col("_row.doc_id").cast("long").alias("doc_id"), "n_bytes", "spans", "kept")
