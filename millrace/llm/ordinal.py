"""Quality classifier: ordinal regression on graded ratings.

One weight per hashed feature, shared by all grades, and ordered thresholds: the chance that
a document's grade is k or more is logistic(score - threshold k).  From these come the
expected grade and the tail probability that selects documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import tokens
from millrace.llm.text import free_name

FEATURE_BITS = 18
SAMPLE_ROWS = 20_000
GRADES = 3
EPOCHS = 12
LEARNING_RATE = 0.15
RIDGE = 2e-4
LEAST_DOCUMENTS = 8
LEAST_DEVIATIONS = 4.0
SHARE_STEPS = 20
RATED = ["by_id", "by_text", "grade", "found"]

_PUNCT = np.zeros(256, np.uint64)
_PUNCT[33:127] = tokens.mixed(np.arange(33, 127, dtype=np.uint64))
_PUNCT[48:58] = _PUNCT[65:91] = _PUNCT[97:123] = 0
_UPPER = tokens._table([(65, 90)])
_SMALL = tokens._table([(97, 122), (128, 255)])


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, powers: tokens.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row, and where each row's begin.

    Words (A-Z lower-cased), the other ASCII signs in a word, and in steps the shares of
    words in capitals, with such signs, without letters and repeated in the row.
    """
    starts, ends, rows = tokens.word_bounds(data, offsets)
    sums = tokens.prefix_hashes(tokens.LOWER[data], powers)
    words = tokens.mixed((sums[ends] - sums[starts]) * powers.down[starts])

    def count(per_byte: np.ndarray) -> np.ndarray:
        running = np.zeros(len(data) + 1, per_byte.dtype)
        np.cumsum(per_byte, out=running[1:])
        return running[ends] - running[starts]

    signs = count(_PUNCT[data])
    upper, small = count(_UPPER[data].astype(np.int32)), count(_SMALL[data].astype(np.int32))
    n_rows = len(offsets) - 1
    of_row = np.repeat(np.arange(n_rows), np.diff(rows))
    n_words = np.maximum(np.diff(rows), 1)
    signed = signs != 0
    keys = [of_row << FEATURE_BITS | _bucket(words)]
    distinct = np.unique(keys[0])
    keys.append(of_row[signed] << FEATURE_BITS | _bucket(tokens.mixed(signs[signed])))
    kinds = ((upper > 1) & (small == 0), signed, (upper == 0) & (small == 0))
    shares = [np.bincount(of_row[kind], minlength=n_rows) / n_words for kind in kinds]
    shares.append(1 - np.bincount(distinct >> FEATURE_BITS, minlength=n_rows) / n_words)
    for k, share in enumerate(shares):
        step = np.ceil(share * SHARE_STEPS).clip(0, SHARE_STEPS).astype(np.uint64)
        h = tokens.mixed(step + np.uint64(1000 * (k + 1)))
        keys.append(np.arange(n_rows) << FEATURE_BITS | _bucket(h))
    found = np.unique(np.concatenate(keys))
    return found & ((1 << FEATURE_BITS) - 1), np.searchsorted(found >> FEATURE_BITS, np.arange(n_rows + 1))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, int]], grades: int = GRADES, seed: int = 7) -> np.ndarray:
    """Weights, then thresholds, from (features, grade) of each document; Adagrad.

    Features of fewer than ``LEAST_DOCUMENTS`` documents keep weight 0, and so do those whose
    documents reach each grade about as often as all: in a long text their noise would add up.
    """
    size = 1 << FEATURE_BITS
    weights, squares = np.zeros(size), np.full(size, 1e-2)
    grade = np.array([g for _, g in rows])
    seen, off = np.zeros(size), np.zeros((grades - 1, size))
    reached = grade[:, None] >= np.arange(1, grades)
    usual = reached.mean(axis=0)
    for (found, _), above in zip(rows, reached - usual):
        seen[found] += 1
        off[:, found] += above[:, None]
    spread = np.sqrt(usual * (1 - usual))[:, None] * np.sqrt(seen)
    telling = (seen >= LEAST_DOCUMENTS) & (np.abs(off) > LEAST_DEVIATIONS * spread).any(axis=0)
    tail = np.array([(np.sum(grade >= k) + 1) / (len(rows) + 2) for k in range(1, grades)])
    thresholds, threshold_squares = np.log(1 / tail - 1), np.full(grades - 1, 1e-2)
    kept = [found[telling[found]] for found, _ in rows]
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for batch in np.array_split(random.permutation(len(rows)), max(len(rows) // 64, 1)):
            if not len(batch):
                continue
            index = np.concatenate([kept[k] for k in batch])
            of = np.repeat(np.arange(len(batch)), [len(kept[k]) for k in batch])
            score = np.bincount(of, weights[index], len(batch))
            g = grade[batch]
            # Likelihood of grade g: P(>= g) - P(>= g + 1), with P(>= 0) = 1 and P(>= grades) = 0.
            edge = np.concatenate([[-30.0], thresholds, [30.0]])
            above, below = _logistic(score - edge[g]), _logistic(score - edge[g + 1])
            likely = np.maximum(above - below, 1e-9)
            up, down = above * (1 - above) / likely, below * (1 - below) / likely
            slope = (up - down)[of]
            squares += np.bincount(index, slope * slope, size)
            total = np.bincount(index, slope, size) - RIDGE * len(batch) * weights * (np.bincount(index, minlength=size) > 0)
            weights += LEARNING_RATE * total / np.sqrt(squares)
            move = np.array([down[g + 1 == k].sum() - up[g == k].sum() for k in range(1, grades)])
            threshold_squares += move**2
            thresholds = np.maximum.accumulate(thresholds + LEARNING_RATE * move / np.sqrt(threshold_squares))
    return np.concatenate([weights, thresholds]).astype(np.float32)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features instead of texts: at most one number for each of the ``FEATURE_BITS``' buckets."""
    powers = tokens.Powers()
    for batch in batches:
        for at, to, data, offsets in tokens.chunks(batch["text"]):
            found, begin = features(data, offsets, powers)
            lists = [found[begin[k] : begin[k + 1]].astype(np.int32).tobytes() for k in range(to - at)]
            rest = batch.slice(at, to - at).select(["by_id", "by_text", "grade"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(lists, pa.binary())], RATED)


def _fit_sample(grades: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            lists = batch["found"].to_pylist()
            rows += [(np.frombuffer(found, np.int32), g) for found, g in zip(lists, batch["grade"].to_pylist())]
        model = fit(rows, grades) if rows else np.zeros((1 << FEATURE_BITS) + grades - 1, np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], ["model"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights and thresholds from ``labels`` (``doc_id``, ``quality``, ``toxic``).

    Fitted in one task on the features of the ``sample_rows`` labels of least hashed id.  Grades: 0 toxic,
    1 of low quality, 2 good.  Labels without id or with a null rating are left out; without
    any label all scores are 0 and both tails one half.
    """
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    rated = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .select("doc_id", grade.alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(sample_rows)
    )
    model = (
        docs.select("doc_id", "text")
        .join(F.broadcast(rated), "doc_id")
        .select(F.xxhash64("doc_id").alias("by_id"), F.xxhash64("text").alias("by_text"), "grade", "text")
        .mapInArrow(_found, "by_id long, by_text long, grade int, found binary")
        .orderBy("by_id", "by_text", "grade")
        .limit(sample_rows)
        .coalesce(1)
        .mapInArrow(_fit_sample(GRADES), "model binary")
        .first()
    )
    if model is None:
        return np.zeros((1 << FEATURE_BITS) + GRADES - 1, np.float32)
    return np.frombuffer(model["model"], np.float32)


def _score(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = tokens.Powers()
        weights, thresholds = model.value[: 1 << FEATURE_BITS], model.value[1 << FEATURE_BITS :]
        for batch in batches:
            tails = np.zeros((len(batch), len(thresholds)))
            for at, to, data, offsets in tokens.chunks(batch["text"]):
                found, begin = features(data, offsets, powers)
                sums = np.concatenate([[0.0], np.cumsum(weights[found], dtype=np.float64)])
                score = sums[begin[1:]] - sums[begin[:-1]]
                tails[at:to] = _logistic(score[:, None] - thresholds[None, :])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])],
                [*batch.schema.names, *names],
            )

    return run


def rate(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``_expected`` (grade, 0 to 2) and ``_tail`` (chance of the top grade) at the end.

    A name that ``docs`` has already gets underscores more.  Reads ``text`` (null: empty) and, to find labelled rows, ``doc_id``.  Every row is rated
    by its own text alone; an empty table gives an empty one.  Trains when called.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))
    names = [free_name(docs, "_expected"), free_name(docs, "_tail")]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, T.DoubleType()) for name in names]])
    return docs.mapInArrow(_score(model, names), schema)


def keep_good(docs: DataFrame, labels: DataFrame, least_tail: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose chance of the top grade is below ``least_tail``."""
    rated = rate(docs, labels)
    return rated.where(F.col(rated.columns[-1]) >= least_tail).select(*docs.columns)
