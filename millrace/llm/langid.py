"""Language identification as a mixture of languages per document.

Each language has likelihoods of byte trigrams, counted over all training documents.  A word's
likelihood under a language is the product over its trigrams.  Expectation-maximisation over
a document's words estimates the language proportions; sets of one, two, ... languages are
compared by likelihood less a penalty per language, and the best set gives the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import tokens

GRAM_BITS = 16
COUNT_BLOCK = 1 << 12
SMOOTHING = 0.5
ROUNDS = 6
UNKNOWN = "und"


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of the words, each word between two blanks; where each word's begin;
    the number of words before each row."""
    starts, ends, rows = tokens.word_bounds(data, offsets)
    low = np.concatenate([[32], tokens.LOWER[data], [32]]).astype(np.uint32)
    low[1:-1][tokens.IS_GAP[data]] = 32
    # A word that touches the border of a row has a blank there, too.
    left, right = low[:-2].copy(), low[2:].copy()
    left[starts], right[ends - 1] = 32, 32
    gram = (left << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | right
    index = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)
    solid = ~tokens.IS_GAP[data]
    before = np.concatenate([[0], np.cumsum(solid)])
    return index[solid].astype(np.int64), before[starts], rows


def _count(languages: list[str]):
    index_of = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << GRAM_BITS), np.int64)
        for batch in batches:
            names = np.array([index_of[n] for n in batch["lang"].to_pylist()], np.int64)
            for at, to, data, offsets in tokens.chunks(batch["text"]):
                grams, words, rows = _grams(data, offsets)
                sizes = np.diff(np.concatenate([words, [len(grams)]])[rows])
                keys = np.repeat(names[at:to] << GRAM_BITS, sizes) | grams
                found, n = np.unique(keys, return_counts=True)
                counts.reshape(-1)[found] += n
        for k, name in enumerate(languages):
            for block in range((1 << GRAM_BITS) // COUNT_BLOCK):
                some = counts[k, block * COUNT_BLOCK : (block + 1) * COUNT_BLOCK]
                if some.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([block], pa.int32()), pa.array([pa.compress(some.tobytes(), "zstd", asbytes=True)], pa.binary())],
                        ["lang", "block", "counts"],
                    )

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for lang, block, packed in zip(*(batch[c].to_pylist() for c in ("lang", "block", "counts"))):
            some = np.frombuffer(pa.decompress(packed, 8 * COUNT_BLOCK, "zstd"), np.int64)
            sums[lang, block] = sums[lang, block] + some if (lang, block) in sums else some
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
        ["lang", "block", "counts"],
    )


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-likelihoods of hashed trigrams, over all of ``docs``.

    The driver receives one table of ``2^GRAM_BITS`` counts per language.
    """
    labelled = docs.where(F.col("lang").isNotNull())
    languages = sorted(row["lang"] for row in labelled.select("lang").distinct().collect())
    counts = np.zeros((len(languages), 1 << GRAM_BITS))
    if languages:
        blocks = (
            labelled.select("lang", "text")
            .mapInArrow(_count(languages), "lang string, block int, counts binary")
            .repartition("lang", "block")
            .mapInArrow(_sum_blocks, "lang string, block int, counts binary")
        )
        index_of = {name: k for k, name in enumerate(languages)}
        for row in blocks.toLocalIterator():
            at = row["block"] * COUNT_BLOCK
            counts[index_of[row["lang"]], at : at + COUNT_BLOCK] = np.frombuffer(row["counts"], np.int64)
    likely = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    return languages, np.log(likely).astype(np.float32).T.copy()


def mixtures(word_likelihood: np.ndarray, rows: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of languages per row, and the log-likelihood, by expectation-maximisation.

    ``word_likelihood``: words x languages, logarithms; -inf leaves a language out.
    """
    begin, sizes = rows[:-1], np.diff(rows)
    some = sizes > 0
    top = word_likelihood.max(axis=1)
    weight = np.exp(word_likelihood - top[:, None])
    n_languages = word_likelihood.shape[1]
    share = np.full((len(begin), n_languages), 1 / n_languages)
    likelihood = np.zeros(len(begin))
    of_row = np.repeat(np.arange(len(begin)), sizes)
    for _ in range(rounds):
        part = weight * share[of_row]
        total = np.maximum(part.sum(axis=1), 1e-300)
        if len(part):
            share[some] = np.add.reduceat(part / total[:, None], begin[some], axis=0) / sizes[some, None]
            likelihood[some] = np.add.reduceat(np.log(total) + top, begin[some])
    return share, likelihood


def choose(word_likelihood: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Proportions per row under the set of languages of best penalised likelihood.

    Sets are the 1, 2, ... up to all languages of largest proportion in the mixture of all;
    each language more must gain log(words) in log-likelihood.  A row is done when even
    the best language for each word would not make up for one language more.
    """
    full, _ = mixtures(word_likelihood, rows)
    order = np.argsort(-full, axis=1, kind="stable")
    sizes = np.diff(rows)
    penalty = np.log(np.maximum(sizes, 1) + 1)
    before = np.concatenate([[0], np.cumsum(word_likelihood.max(axis=1))])
    most = before[rows[1:]] - before[rows[:-1]]
    best, score = np.zeros_like(full), np.full(len(full), -np.inf)
    for k in range(1, full.shape[1] + 1):
        left = np.flatnonzero(most - (k - 1) * penalty > score)
        if not len(left):
            break
        is_left = np.zeros(len(full), bool)
        is_left[left] = True
        inside = np.zeros((len(left), full.shape[1]), bool)
        np.put_along_axis(inside, order[left, :k], True, axis=1)
        some = word_likelihood[np.repeat(is_left, sizes)]
        kept = np.where(np.repeat(inside, sizes[left], axis=0), some, -np.inf)
        share, likelihood = mixtures(kept, np.concatenate([[0], np.cumsum(sizes[left])]), ROUNDS)
        penalised = likelihood - (k - 1) * penalty[left]
        better = penalised > score[left]
        best[left[better]], score[left[better]] = share[better], penalised[better]
    return best


def _identify(languages: list[str], model):
    names = np.array([*languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            letters = batch["_letters"].to_numpy(zero_copy_only=False)
            answer, score = np.full(len(batch), len(languages)), np.zeros(len(batch))
            shares = np.zeros((len(batch), len(languages)))
            for at, to, data, offsets in tokens.chunks(batch["text"]) if languages else ():
                grams, words, rows = _grams(data, offsets)
                if not len(words):
                    continue
                likelihood = np.add.reduceat(table[grams], words, axis=0).astype(np.float64)
                shares[at:to] = choose(likelihood, rows)
            if languages:
                known = letters & (shares.max(axis=1) > 0)
                answer[known] = shares.argmax(axis=1)[known]
                score[known] = np.clip(shares.max(axis=1)[known], 0, 1)
            mixture = [
                {languages[k]: float(s) for k, s in enumerate(row) if s > 0.005} if ok else {}
                for row, ok in zip(shares, letters)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(names[answer].tolist(), pa.string()),
                    pa.array(score),
                    pa.array([list(m.items()) for m in mixture], pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    return run


def identify(docs: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` per row, from ``text`` alone.

    ``languages`` has the proportions of the selected set.  ``und`` with score 0 for null
    texts and texts without a letter.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("languages", T.MapType(T.StringType(), T.DoubleType())),
        ]
    )
    return docs.select("doc_id", "text", letters).mapInArrow(_identify(languages, sent), schema)
