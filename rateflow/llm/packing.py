"""Packing of token sequences by best-fit decreasing.

A document's ids are cut into full windows first, each a sequence of its own. All pieces are
dealt by a hash over groups of about ``group_size`` documents (their count follows the
table), and each group is packed longest first: a segment tree indexed by remaining capacity
finds the tightest open sequence in log(window) steps. The groups' last, partly empty
sequences are the price of packing them apart; at thousands of pieces a group it is small.

The pieces' ids are what the shuffle moves, so a piece travels in 16 bits an id if all of its
ids fit, and in 32 if not; the groups give all of them back in 32.

Defined cases: null text is empty, so the document is its end id alone; rows that repeat a
document are packed once each; an empty table gives an empty result; extra columns are not
carried. Any integer ``doc_id`` may be null.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import doc_key, sliced

#: Pieces remembered per Python worker; beyond it the memory starts anew.
WORDS_KEPT = 600_000
#: Characters of the texts that are encoded together.
TOGETHER = 4_000_000


class CapacityTree:
    """Open sequences by remaining capacity, 0 to ``window``: the segment tree's leaves hold
    them, its inner nodes count them."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: dict[int, list[int]] = {}

    def add(self, capacity: int, sequence: int) -> None:
        self.open.setdefault(capacity, []).append(sequence)
        self._change(capacity, 1)

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the sequence with the least remaining capacity of at least ``length``."""
        node = self.size + length
        if not self.count[node]:
            # climb until a right sibling has open sequences, then descend to its leftmost leaf
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.count[node]:
                    node += 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.open[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, longest pieces first."""
    tree, sequences = CapacityTree(window), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take_tightest(lengths[i])
        if found is None:
            found, sequences = (window, sequences), sequences + 1
        capacity, sequence[i] = found
        offset[i] = window - capacity
        tree.add(capacity - lengths[i], sequence[i])
    return sequence, offset


class WordEncoder(dict):
    """Ids (little-endian 32-bit) of texts, each distinct piece of a word encoded once and, among
    texts encoded together, looked up once.

    The vocabulary drops white space and never joins ids across it or across the pieces of a word,
    so a text's ids are its pieces' ids in turn. That holds as used here for Latin-1 texts, where
    lower-casing and composing are done character by character; any other text goes to the
    tokenizer whole."""

    #: Fixed value: the tokenizer file's split pattern, without its letter runs, which are what is left between the others.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\v\x{85}\x{a0}\p{L}\p{N}]+"
    #: Python and Arrow take these for white space, the pattern doesn't.
    ODD_SPACE = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()

    def __missing__(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
        found = self[piece] = array("I", [t.id for t in tokens]).tobytes()
        return found

    def by_piece(self, text: str) -> bool:
        """Whether a text's ids are its pieces' ids."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(c in text for c in self.ODD_SPACE) and "<|" not in text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self) > WORDS_KEPT:
            self.clear()
        cut = [self.by_piece(t) for t in texts]
        lowered = pa.array([t.lower() if c else "" for t, c in zip(texts, cut, strict=True)], pa.large_string())
        pieces = pc.utf8_split_whitespace(pc.replace_substring_regex(lowered, self.PATTERN, r" \0 "))
        coded = pieces.flatten().dictionary_encode()
        known = [self[p] for p in coded.dictionary.to_numpy(zero_copy_only=False)]
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids))])[pieces.offsets.to_numpy()]
        joined = ids.buffers()[2] or b""
        return [
            bytes(joined[lo:hi]) if c else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t, c, lo, hi in zip(texts, cut, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def ids(self, text: str) -> bytes:
        return self.encode([text])[0]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the others for characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


_encoders: dict[str, WordEncoder] = {}


def together(texts: list[str], most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Ranges of texts, in turn, that have about ``most`` characters each; a longer text is in its range the last."""
    lo = size = 0
    for hi, text in enumerate(texts, 1):
        size += len(text)
        if size >= most or hi == len(texts):
            yield lo, hi
            lo, size = hi, 0


def narrowed(ids: bytes) -> bytes:
    """32-bit ids in 16 bits each, if all of them fit."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else ids


def widened(ids: bytes, length: int) -> bytes:
    """The 32-bit ids of a piece of ``length`` ids."""
    return ids if len(ids) == 4 * length else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


_PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


def _pieces(path: str, end_id: int, window: int):
    """Map step: a row per piece; ``key`` deals them over the groups."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("key", pa.int64())])

    def rows(out):
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def run(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
        end, row = np.array([end_id], "<u4").tobytes(), 0
        for batch in sliced(batches):
            out: list[tuple] = []
            size = 0
            docs, keys, texts = (c.to_pylist() for c in batch.columns)
            found = chain.from_iterable(encoder.encode(texts[lo:hi]) for lo, hi in together(texts))
            for doc, key, ids in zip(docs, keys, found, strict=True):
                ids, row = ids + end, row + 1
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    # windows of a long document and repeated rows go to different groups
                    out.append((doc, start, length, n, narrowed(ids[start * 4:(start + length) * 4]), key ^ (start * 0x9E3779B1 + row)))
                size += len(ids)
                if size > 8_000_000:
                    yield rows(out)
                    out, size = [], 0
            if out:
                yield rows(out)

    return run


def _pack_group(window: int):
    def run(pieces: pa.Table) -> pa.Table:
        # a fixed order, whatever order the shuffle brought
        pieces = pieces.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        group, lengths = pieces["group"][0].as_py(), pieces["length"].to_pylist()
        sequence, offset = best_fit_decreasing(lengths, window)
        ids = pa.chunked_array([
            pa.array([widened(i, n) for i, n in zip(*(c.to_pylist() for c in rows.columns), strict=True)], pa.binary())
            for rows in sliced(pieces.select(["ids", "length"]).to_batches())])
        return pieces.set_column(pieces.column_names.index("ids"), "ids", ids).drop_columns(["group", "key"]).append_column(
            "sequence_id", pa.array([group << 32 | s for s in sequence], pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, group_size: int = 4000) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``sequence_id`` and ``offset``. ``tokenizer`` is the path of
    the vocabulary file on the executors."""
    groups = max(1, round(docs.count() / group_size))
    pieces = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).mapInArrow(_pieces(tokenizer, end_id, window), f"{_PIECE}, key long")
    return (
        pieces.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
        .groupBy("group").applyInArrow(_pack_group(window), f"{_PIECE}, sequence_id long, offset long")
    )
