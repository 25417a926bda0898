"""Quality classifier: ordinal cumulative-link regression on graded ratings (operator 4).

A text is a sparse vector of hashed features: which words and which runs of
marks it has, how often each run of marks occurs, how many words are in
capitals, how many words repeat. A feature is scaled by the root of the share
of training texts that have it, so rare words, which cannot be learnt, weigh
little. All grades share one weight vector w; ordered thresholds t_1 < t_2 ...
give ``P(grade >= k) = sigmoid(w x - t_k)``. Expected grade and tail
probabilities follow, and a tail probability selects the documents.

The weights are fitted by L-BFGS on a bounded sample of the labelled rows
(``max_rows``, chosen by a hash of the id; about that many, labels beyond it
are not used). Features of the sample are stored; each step's loss and gradient
is a Spark job over them: ``FIT_TASKS`` tasks make a partial sum each, one adds
them up in the order of the tasks, and one vector over the features that occur
in the sample comes back. Nothing a step sends outlives it. Scoring reads every
document whole; its tasks carry the weights that are not zero.

Defined results: a null or empty text has no features and gets the grade the
thresholds alone give; rows with a null label or id are not used for fitting,
of several labels for an id the lowest counts; without any label the grades
are equally likely a priori; rows are scored on their own, so repeated rows
agree and null ids are kept; an empty table gives an empty result; labels of
which none is sampled raise an error, as an untrained model would keep every
document; other columns pass through ``select_documents`` and are not read by ``grades``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bounded_batches, materialize
from .shingles import mix

BITS = 18
FEATURES = 1 << BITS
MAX_ROWS = 6000
FIT_TASKS = 6
ITERATIONS = 30
HISTORY = 8
PENALTY = 0.1
# Features beside the hashed ones.
CAPITALS, REPEATS = FEATURES, FEATURES + 1
WIDTH = FEATURES + 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_KIND = np.full(256, _MARK, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_KIND[48:58] = _DIGIT
_PLACES = 64
_TABLE = np.random.Generator(np.random.PCG64(4)).integers(0, 1 << 64, size=_PLACES * 256, dtype=np.uint64)


def text_features(data: bytes | pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (each once) and values of a UTF-8 text."""
    codes = np.frombuffer(data, dtype=np.uint8)
    if not len(codes):
        return np.empty(0, dtype=np.int32), np.empty(0)
    kind = _KIND[codes]
    starts = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    lengths = np.diff(np.append(starts, len(codes)))
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    hashes = mix(np.add.reduceat(_TABLE[(place % _PLACES) * 256 + _LOWER[codes]], starts))
    run = kind[starts]
    words, marks = hashes[run == _LETTER], hashes[run == _MARK]
    n = max(1, len(words))
    capitals = np.add.reduceat(((codes >= 65) & (codes <= 90)).astype(np.int64), starts)
    shouted = int(((run == _LETTER) & (capitals == lengths) & (lengths > 1)).sum())
    shift = np.uint64(64 - BITS)
    present, distinct = np.unique(np.concatenate([words, marks]) >> shift), len(np.unique(words))
    which, often = np.unique(mix(marks + np.uint64(1)) >> shift, return_counts=True)
    numbers = np.concatenate([present, which, [CAPITALS, REPEATS]]).astype(np.int64)
    values = np.concatenate([np.ones(len(present)), 3 * np.minimum(often / n, 5), [3 * shouted / n, 3 * (1 - distinct / n)]])
    numbers, at = np.unique(numbers, return_inverse=True)
    return numbers.astype(np.int32), np.bincount(at, weights=values)


@dataclass
class Model:
    """Scaled weights and thresholds; of fixed size whatever the input."""

    weights: np.ndarray
    thresholds: np.ndarray

    def __getstate__(self) -> tuple:
        """What tasks are sent: the weights that are not zero."""
        numbers = np.flatnonzero(self.weights).astype(np.int32)
        return len(self.weights), numbers, self.weights[numbers], self.thresholds

    def __setstate__(self, state: tuple) -> None:
        width, numbers, weights, self.thresholds = state
        self.weights = np.zeros(width)
        self.weights[numbers] = weights

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1 .. grades - 1, a column each."""
        return _sigmoid(scores[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _ordered(raw: np.ndarray) -> np.ndarray:
    """Thresholds from a first one and the logarithms of the steps between them."""
    return np.cumsum(np.append(raw[0], np.exp(raw[1:])))


def _loss(grades: np.ndarray, scores: np.ndarray, thresholds: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood, its derivative by score and by threshold."""
    ends = np.concatenate([[-np.inf], thresholds, [np.inf]])
    upper, lower = (np.where(np.isinf(e), e > 0, _sigmoid(e - scores)) for e in (ends[grades + 1], ends[grades]))
    p = np.maximum(upper - lower, 1e-12)
    slope_up, slope_low = upper * (1 - upper), lower * (1 - lower)
    by_threshold = np.zeros(len(ends))
    np.add.at(by_threshold, grades + 1, -slope_up / p)
    np.add.at(by_threshold, grades, slope_low / p)
    return float(-np.log(p).sum()), (slope_up - slope_low) / p, by_threshold[1:-1]


def training_rows(df: DataFrame, labels: DataFrame, grade: Column, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Stored ``(grade, numbers, values)`` of about ``max_rows`` labelled documents at most."""
    graded = labels.select(F.col(id_col).alias("of_id"), grade.cast("int").alias("grade")).where("of_id is not null and grade is not null")
    graded = graded.groupBy("of_id").agg(F.min("grade").alias("grade"))
    sample = graded
    n_graded = graded.count()
    if n_graded > max_rows:
        # The whole hash is compared, so the share is never rounded to nothing.
        sample = graded.where(F.xxhash64("of_id") < F.lit(-(1 << 63) + (max_rows << 64) // n_graded))
    # The sample has a bounded number of rows of two numbers each.
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    texts = texts.join(F.broadcast(sample), F.col("id") == F.col("of_id")).select("grade", "data")
    schema = pa.schema([("grade", pa.int32()), ("numbers", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for level, data in zip(*batch.columns, strict=True):
                    numbers, values = text_features(data.as_buffer())
                    yield 12 * len(numbers), (level.as_py(), numbers, values)

        return bounded_batches(rows(), schema)

    found = texts.mapInArrow(run, "grade int, numbers array<int>, values array<double>")
    return materialize(found.repartition(FIT_TASKS), "graded")


_TOTAL = pa.schema([("task", pa.int32()), ("total", pa.binary())])


def _summed(rows: DataFrame, one) -> np.ndarray | None:
    """Sum of the vectors that ``one(grades, row, numbers, values)`` makes of the rows of each task; None without rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                grades = batch.column(0).to_numpy().astype(np.int64)
                lengths = batch.column(1).value_lengths().to_numpy()
                row = np.repeat(np.arange(len(grades)), lengths)
                total = total + one(grades, row, batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "total": [total.tobytes()]}, schema=_TOTAL)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((t, v) for b in batches for t, v in zip(*(c.to_pylist() for c in b.columns), strict=True))
        if parts:
            total = np.sum([np.frombuffer(v) for _, v in parts], axis=0)
            yield pa.RecordBatch.from_pydict({"task": [0], "total": [total.tobytes()]}, schema=_TOTAL)

    parts = rows.coalesce(FIT_TASKS).mapInArrow(part, "task int, total binary")
    found = parts.repartition(1).mapInArrow(whole, "task int, total binary").collect()  # FIT_TASKS vectors in, one out
    return np.frombuffer(found[0].total) if found else None


def fit(
    df: DataFrame, labels: DataFrame, grade: Column, n_grades: int, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS
) -> Model:
    """Fit weights and thresholds; ``grade`` is an expression over ``labels``, 0 .. n_grades - 1."""
    rows = training_rows(df, labels, grade, max_rows, id_col, text_col)
    context = df.sparkSession.sparkContext

    def counted(grades, row, numbers, values):
        return np.concatenate([np.bincount(grades, minlength=n_grades), np.bincount(numbers, minlength=WIDTH)]).astype(float)

    counts = _summed(rows, counted)
    if counts is None:
        if labels.where(F.col(id_col).isNotNull() & grade.isNotNull()).join(df, id_col, "left_semi").take(1):
            raise ValueError("there are labelled documents, but none is in the training sample")
        counts = np.zeros(n_grades + WIDTH)
    of_grade = counts[:n_grades] + 1
    # Only features of the sample have weights; the others cannot be learnt and stay zero.
    known = np.flatnonzero(counts[n_grades:])
    scale = np.sqrt(counts[n_grades:][known] / max(1.0, counts[:n_grades].sum()))
    width = len(known)
    below = np.cumsum(of_grade)[:-1] / of_grade.sum()
    start = np.log(below / (1 - below))
    x = np.concatenate([np.zeros(width), start[:1], np.log(np.diff(start))])

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((known.astype(np.int32), x[:width] * scale, _ordered(x[width:])))

        def part(grades, row, numbers, values):
            known, weights, thresholds = shared.value
            place = np.searchsorted(known, numbers)
            scores = np.bincount(row, weights=values * weights[place], minlength=len(grades))
            loss, by_score, by_threshold = _loss(grades, scores, thresholds)
            return np.concatenate([[loss], np.bincount(place, weights=values * by_score[row], minlength=len(known)), by_threshold])

        total = _summed(rows, part)
        shared.destroy()
        w, raw = x[:width], x[width:]
        by_threshold = total[1 + width :]
        by_raw = np.append(by_threshold.sum(), [by_threshold[k:].sum() * np.exp(raw[k]) for k in range(1, len(raw))])
        return total[0] + PENALTY / 2 * float(w @ w), np.concatenate([total[1 : 1 + width] * scale + PENALTY * w, by_raw])

    if counts[:n_grades].sum():
        x = _minimize(evaluate, x)
    weights = np.zeros(WIDTH)
    weights[known] = x[:width] * scale
    return Model(weights, _ordered(x[width:]))


def _minimize(evaluate, x: np.ndarray) -> np.ndarray:
    """L-BFGS with halved steps; the state is a few vectors of the model's size."""
    value, gradient = evaluate(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ITERATIONS):
        direction, alphas = -gradient, []
        for s, d in reversed(moves):
            alphas.append(s @ direction / (s @ d))
            direction = direction - alphas[-1] * d
        direction = direction * (moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.linalg.norm(gradient)))
        for (s, d), alpha in zip(moves, reversed(alphas), strict=True):
            direction = direction + s * (alpha - d @ direction / (s @ d))
        step = 1.0
        while True:
            new_value, new_gradient = evaluate(x + step * direction)
            if new_value <= value + 1e-4 * step * (gradient @ direction) or step < 1e-4:
                break
            step /= 2
        if new_value >= value:
            return x
        s, d = step * direction, new_gradient - gradient
        if s @ d > 1e-10:
            moves = [*moves, (s, d)][-HISTORY:]
        settled = value - new_value < 1e-3 * abs(value)
        x, value, gradient = x + s, new_value, new_gradient
        if settled:
            break
    return x


def _scored(df: DataFrame, model: Model, keep: list[str], data: str) -> DataFrame:
    """``keep`` columns, ``expected_grade`` and ``p_at_least_1`` ... from the binary column ``data``."""
    n, levels = len(keep), len(model.thresholds)
    source = df.select(*keep, data)
    added = ["expected_grade", *(f"p_at_least_{k}" for k in range(1, levels + 1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(n)):
                numbers, values = text_features(text.as_buffer())
                scores[i] = values @ model.weights[numbers]
            tails = model.tails(scores)
            columns = [*batch.columns[:n], pa.array(tails.sum(axis=1)), *(pa.array(t) for t in tails.T)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n], *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n]]
    return source.mapInArrow(run, ", ".join([*fields, *(f"{c} double" for c in added)]))


def grades(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, expected_grade, p_at_least_1, ...)`` of every document."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("id"), data.alias("data"))
    return _scored(rows, model, ["id"], "data").withColumnRenamed("id", id_col)


def select_documents(df: DataFrame, model: Model, level: int = 1, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all columns) whose grade is at least ``level`` with probability ``least``."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(at).cast(pa.binary())):
                numbers, values = text_features(text.as_buffer() if text.is_valid else b"")
                scores[i] = values @ model.weights[numbers]
            yield batch.filter(pa.array(model.tails(scores)[:, level - 1] >= least))

    return df.mapInArrow(run, df.schema)
