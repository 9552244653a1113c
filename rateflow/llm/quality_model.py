"""Quality scores of texts: random Fourier features, ridge regression and isotonic calibration.

Every text becomes a short vector of statistics (``STATISTICS``). Standardised, it is mapped to
cosines of random projections, whose inner products approximate a Gaussian kernel (Rahimi and
Recht, 2007). Ridge regression on these features needs only the normal equations. Each task sums
its rows' part of them per fold, and the sums (folds x features x features whole numbers) are all
that reaches the driver, whatever the number of rows. Cosines are rounded to whole numbers of 1/4096 before
they are multiplied, so the sums do not depend on the order.

As the sums add up, the model without one fold is that of the total less the fold's part. So the
penalty with the least error on rows left out follows from the sums alone, and one more pass
scores each labelled row by the model that has not seen it. These scores, counted in bins of
1/1024, are made monotone by pooling adjacent violators. Scores between two pooled blocks are
interpolated.

All labelled rows take part; nothing is sampled.

Defined cases: null text is empty, and an empty text has statistics of 0 and is scored like any
other; a label counts if it is 0 or 1 and its id is not null; several labels of an id count as their mean; rows
that repeat an id are labelled alike; without a usable label every score is 0.5; where all labels are equal,
every score is their mean; repeated rows are scored alike; an empty table gives an empty result;
extra columns are not carried.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written

FEATURES, FOLDS = 256, 5
#: Width of the Gaussian kernel, in standard deviations a statistic.
WIDTH = 1.0
PENALTIES = tuple(10.0**e for e in range(-7, 1))
_UNIT, _BINS = 4096, 1024

STATISTICS = (
    "log_words", "letters", "capitals", "digits", "spaces", "sentence_marks", "other_marks", "line_breaks", "word_length",
    "word_length_spread", "distinct_words", "commonest_word", "echoes", "repeated_triples", "capital_words", "marked_words",
    "bare_marks", "words_a_line", "repeated_lines", "unended_lines",
)

_WORD = re.compile(r"\S+")
_MARKED = re.compile(r"\w[^\w\s.,;:!?'’\"»)\]-]|\w[!?]{2}")
_BARE = re.compile(r"[\W_]+")


def _class_table() -> np.ndarray:
    """Class of each code point: 0 other mark, 1 small letter, 2 capital, 3 digit, 4 space, 5 mark of a sentence, 6 line break."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x30000):
        x = chr(c)
        table[c] = 6 if x == "\n" else 4 if x.isspace() else 3 if x.isdigit() else 2 if x.isupper() else 1 if x.isalpha() else 0
    table[[ord(x) for x in ".,;:!?'’\"«»()-¿¡"]] = 5
    return table


_classes: list[np.ndarray] = []


def statistics(text: str | None) -> np.ndarray:
    """The ``STATISTICS`` of a whole text."""
    out = np.zeros(len(STATISTICS))
    words = _WORD.findall(text or "")
    if not words:
        return out
    if not _classes:
        _classes.append(_class_table())
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_classes[0][codes], minlength=7)
    n, chars = len(words), len(codes)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    number = {w: i for i, w in enumerate(counts)}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    lines = [s for x in text.split("\n") if (s := x.strip())]
    out[0] = np.log1p(n)
    out[1:8] = np.array([kinds[1] + kinds[2], kinds[2], kinds[3], kinds[4], kinds[5], kinds[0], kinds[6]]) / chars
    out[8], out[9] = lengths.mean(), lengths.std()
    # a text of n different words drawn at random repeats some: compared with a power of n
    out[10] = len(counts) / n**0.8
    out[11] = max(counts.values()) / n if n > 9 else 0
    out[12] = (ids[1:] == ids[:-1]).mean() if n > 1 else 0
    if n > 3:
        triples = (ids[:-2] * n + ids[1:-1]) * n + ids[2:] if n < 1 << 20 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True)[1].ravel()
        out[13] = 1 - len(np.unique(triples)) / len(triples)
    out[14] = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n
    out[15] = sum(c for w, c in counts.items() if _MARKED.search(w)) / n
    out[16] = sum(c for w, c in counts.items() if _BARE.fullmatch(w)) / n
    out[17] = np.log1p(n / len(lines))
    out[18] = 1 - len(set(lines)) / len(lines)
    out[19] = sum(x[-1] not in ".!?:;\"'»”)" for x in lines) / len(lines)
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of every row."""

    def run(batches):
        for batch in batches:
            rows = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, len(STATISTICS))
            stats = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class QualityModel:
    """Standardisation, projections, weights (the last row fits all labels, the others all but their fold) and
    the calibration curve."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: np.ndarray  # raw scores, rising, and the calibrated score at each
    to: np.ndarray
    penalty: float = 0.0

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Whole-number cosines, and a constant."""
        rng = np.random.default_rng(11)
        turn = rng.normal(size=(stats.shape[1], FEATURES)) / (WIDTH * np.sqrt(stats.shape[1]))
        shift = rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        return np.concatenate([np.rint(np.cos(x @ turn + shift) * _UNIT), np.full((len(x), 1), float(_UNIT))], axis=1)

    def raw(self, stats: np.ndarray, model: int | np.ndarray = -1) -> np.ndarray:
        """Scores by one model, or by each row's own."""
        x = self.features(stats) / _UNIT
        # no matrix product: its sums depend on a row's place in the batch
        return np.einsum("ij,j->i" if np.isscalar(model) else "ij,ij->i", x, self.weights[model])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.to) if len(self.at) else np.full(len(raw), 0.5)


def pooled(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: centre and value of each block."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, value, weight, strict=True):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks).reshape(-1, 3)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def _sums(model: QualityModel, labelled: DataFrame) -> dict[int, np.ndarray]:
    """Per fold the sums of features x (features, target), added up in tasks, then by matrix row."""
    size = FEATURES + 1

    def part(batches):
        sums = np.zeros((FOLDS, size, size + 1), np.int64)
        for batch in batches:
            x, y, fold = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for f in np.unique(fold):
                mine = x[fold == f]
                sums[f] += (mine.T @ np.concatenate([mine, np.rint(y[fold == f, None] * _UNIT)], axis=1)).astype(np.int64)
        folds = np.flatnonzero(sums[:, -1, -2])  # those with rows
        if len(folds):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(folds, size).astype(np.int32)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(folds))),
                pa.FixedSizeListArray.from_arrays(pa.array(sums[folds].ravel()), size + 1).cast(pa.list_(pa.int64()))], names=["fold", "at", "part"])

    def total(rows: pa.Table) -> pa.Table:
        parts = rows["part"].combine_chunks()
        whole = _matrix(parts).sum(axis=0)
        return pa.table([rows["fold"][:1], rows["at"][:1], pa.array([whole.tolist()], pa.list_(pa.int64()))], names=["fold", "at", "part"])

    kind = "fold int, at int, part array<long>"
    out: dict[int, np.ndarray] = {}
    for r in labelled.select("stats", "y", "fold").mapInArrow(part, kind).groupBy("fold", "at").applyInArrow(total, kind).collect():
        out.setdefault(r.fold, np.zeros((size, size + 1)))[r.at] = np.array(r.part, float) / _UNIT**2
    return out


def _solve(system: np.ndarray, penalty: float) -> np.ndarray:
    n = system[-1, -2]
    ridge = np.full(len(system), penalty * n)
    ridge[-1] = 1e-9 * n  # the constant is free
    return np.linalg.solve(system[:, :-1] + np.diag(ridge), system[:, -1])


def fit(measured: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    """The model of ``label`` (0 or 1, by ``doc_id``) over ``measured`` rows (``measure``)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0.0, 1.0)).groupBy("doc_id").agg(F.avg("y").alias("y"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    labelled = written(measured.join(known, "doc_id").select("stats", "y", fold), "labelled")
    size = len(STATISTICS)
    moments = labelled.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(size)]).collect()[0]
    blank = QualityModel(np.zeros(size), np.ones(size), np.zeros((FOLDS + 1, FEATURES + 1)), np.empty(0), np.empty(0))
    if not moments.n:
        return blank
    if moments.y in (0.0, 1.0):
        blank.at, blank.to = np.array([0.0]), np.array([moments.y])
        return blank
    # nine digits: the same for any order of the rows
    rounded = [float(f"{x:.9g}") for x in moments[2:]]
    model = QualityModel(np.array(rounded[:size]), np.maximum(rounded[size:], 1e-6), blank.weights, blank.at, blank.to)
    sums = _sums(model, labelled)
    whole = sum(sums.values())
    without = {f: whole - s if len(sums) > 1 else whole for f, s in sums.items()}

    def error(penalty: float) -> float:
        # the squares of the targets are the same for all penalties
        of = ((s, _solve(without[f], penalty)) for f, s in sums.items())
        return sum(w @ s[:, :-1] @ w - 2 * w @ s[:, -1] for s, w in of)

    model.penalty = min(PENALTIES, key=error)
    model.weights = np.array([_solve(without.get(f, whole), model.penalty) for f in range(FOLDS)] + [_solve(whole, model.penalty)])

    def bins(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)), batch.column(2).to_numpy())
            at = np.rint(np.clip(raw, -1, 2) * _BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["at", "y"])

    # at most three times _BINS rows
    counted = labelled.select("stats", "y", "fold").mapInArrow(bins, "at int, y double").groupBy("at").agg(
        F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("at").collect()
    model.at, model.to = pooled(*(np.array([r[i] for r in counted], float) / (_BINS if not i else 1) for i in range(3)))
    return model


def score(measured: DataFrame, model: QualityModel, good: float = 0.7) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from ``good`` on) of every row."""

    def run(batches):
        for batch in batches:
            scores = np.clip(model.calibrated(model.raw(_matrix(batch.column(1)))), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= good).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return measured.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double, predicted int")
