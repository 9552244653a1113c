"""Language ID with hyperdimensional profiles.

Each letter of any script, and a gap for runs of anything that is no letter, has a random +1/-1
vector, drawn by a hash of its code point. A letter trigram is bound as the product of its letters'
vectors, permuted (rotated) by their places; a document bundles (adds) its trigrams; a
language's prototype bundles its training documents. A document gets the language whose
prototype, less the mean of all prototypes, has the greatest cosine with its own vector.

Training is one pass: tasks send a sum per language, and the sums (languages x dimensions
whole numbers) are all that reaches the driver. Document vectors are scaled to whole numbers
before they are added, so the sums do not depend on the order.

Defined cases: null text and text without letters are ``und`` with score 0; a null language
trains nothing; without any training document every language is ``und``; ties go to the
first language in alphabetical order; repeated rows are predicted alike; an empty table
gives an empty result; extra columns are kept, but for those named as the two outputs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateflow.llm.common import sliced

DIMENSIONS = 512
#: The gap and a to z: their trigrams' vectors are kept, others are made where they occur.
_PLAIN = 27
UNKNOWN = "und"


@lru_cache(1)
def _symbol_table() -> np.ndarray:
    """Symbol of each code point: 0 for no letter, 1 to 26 for a to z, else the code point."""
    table = np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint32)
    table[97:123] = np.arange(1, _PLAIN)
    return table


def _letters(symbols: np.ndarray) -> np.ndarray:
    """Each symbol's vector: the bits of a hash (splitmix64) of the symbol and the place."""
    words = DIMENSIONS // 64
    with np.errstate(over="ignore"):
        x = (symbols.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def _bound(trigrams: np.ndarray) -> np.ndarray:
    """Vectors of trigrams (rows of three symbols)."""
    used, at = np.unique(trigrams, return_inverse=True)
    vectors, at = _letters(used), at.reshape(trigrams.shape)
    return np.roll(vectors, 2, axis=1)[at[:, 0]] * np.roll(vectors, 1, axis=1)[at[:, 1]] * vectors[at[:, 2]]


@lru_cache(1)
def _plain_trigrams() -> np.ndarray:
    """Vectors of the trigrams of gaps and a to z."""
    return _bound(np.stack(np.unravel_index(np.arange(_PLAIN**3), (_PLAIN,) * 3), axis=1))


def bundle(text: str | None) -> np.ndarray | None:
    """Vector of a text; None if it has no letters."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _symbol_table()[codes]
    symbols = symbols[(symbols != 0) | np.concatenate(([True], symbols[:-1] != 0))]  # one gap per run
    if not symbols.any():
        return None
    # one gap before and behind
    symbols = np.concatenate(([0] * int(symbols[0] != 0), symbols, [0] * int(symbols[-1] != 0))).astype(np.int64)
    first, second, third = symbols[:-2], symbols[1:-1], symbols[2:]
    small = symbols < _PLAIN
    plain = slice(None) if (same := small.all()) else small[:-2] & small[1:-1] & small[2:]
    counts = np.bincount((first[plain] * _PLAIN + second[plain]) * _PLAIN + third[plain], minlength=_PLAIN**3)
    used = np.flatnonzero(counts)
    total = counts[used].astype(np.float32) @ _plain_trigrams()[used].astype(np.float32)
    if not same:
        others, counts = np.unique(((first << 42) | (second << 21) | third)[~plain], return_counts=True)
        for i in range(0, len(others), 4096):
            part = others[i:i + 4096]
            total += counts[i:i + 4096].astype(np.float32) @ _bound(np.stack((part >> 42, (part >> 21) & 0x1FFFFF, part & 0x1FFFFF), axis=1)).astype(np.float32)
    return total


def _train(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in sliced(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if (v := bundle(text)) is not None:
                own = sums.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
                own += np.rint(v * (1e4 / np.linalg.norm(v))).astype(np.int64)
    for lang, own in sums.items():
        yield pa.record_batch([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS)), pa.array(own)], names=["lang", "at", "value"])


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages of ``labelled`` (text, lang) and their prototypes, one row each."""
    sums = (
        labelled.filter(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_train, "lang string, at long, value long")
        .groupBy("lang", "at").agg(F.sum("value").alias("value"))
        .collect()  # languages x dimensions numbers
    )
    languages = sorted({r.lang for r in sums})
    rows = np.zeros((len(languages), DIMENSIONS))
    for r in sums:
        rows[languages.index(r.lang), r.at] = r.value
    if len(languages):
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    if len(languages) > 1:
        rows -= rows.mean(axis=0)
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return languages, rows


def classify(docs: DataFrame, languages: list[str], profiles: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the cosine, at least 0)."""
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")

    def run(batches):
        for batch in sliced(batches):
            names, scores = [], []
            for text in batch.column(at).to_pylist():
                v = bundle(text) if languages else None
                if v is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                near = profiles @ v.astype(np.float64) / max(float(np.linalg.norm(v)), 1e-9)
                best = int(np.argmax(near))
                names.append(languages[best])
                scores.append(float(min(1.0, max(0.0, near[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    out = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, out)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept out of training: by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled documents that are not held out, then predict every document."""
    languages, profiles = prototypes(docs.filter(~held_out()).select("text", "lang"))
    return classify(docs, languages, profiles)
