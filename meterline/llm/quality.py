"""Quality ranking learned from preference pairs by a Bradley-Terry model.

A document labelled good is preferred to one labelled bad.  The probability of a preference
is the logistic function of the difference of two scores, which are linear in features of
the text, so the weights follow from logistic loss on feature differences.  The threshold
between good and bad is the quantile of the scores that leaves the labelled share of bad
documents below it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import broadcast, map_arrow, received, row_slices, unused
from meterline.llm.words import SPACED, U64, Words, find_words, text_bytes

# Labelled documents that the fit uses at most, and pairs per document of the rarer label.
MOST_LABELLED = 20_000
PAIRS_EACH = 8
ROUNDS = 40
PENALTY = 1e-3
ACCEPTED = 0.7
HELD_OUT_OF = 4
HELD_OUT = 2

FEATURES = (
    "upper", "marks", "stops", "digits", "wide", "lines", "repeated", "distinct", "bigrams", "length", "words", "long",
)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"#$%&*+/<=>?@\\^_`{|}~;"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(values[low:high])) for low, high in zip(first[:-1], first[1:])], float)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` per text; shares are square roots, so that small ones show."""
    data, offsets = text_bytes(column)
    words: Words = find_words(column, SPACED)
    counts, size = words.counts.astype(float), np.diff(offsets).astype(float)
    hashes = words.hashes()
    owner = np.repeat(np.arange(len(counts)), words.counts)
    follows = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
    same = follows.copy()
    same[1:] &= hashes[1:] == hashes[:-1]
    pairs = hashes.copy()
    pairs[1:] = hashes[1:] + hashes[:-1] * U64(0x9E3779B97F4A7C15)
    letters, tokens = np.maximum(_per_text(_LETTER[data], offsets), 1), np.maximum(counts, 1)
    chars = np.maximum(size, 1)
    widths = words.end - words.start
    long = np.bincount(owner, weights=widths > 12, minlength=len(counts))
    shares = [
        _per_text(_UPPER[data], offsets) / letters,
        _per_text(_MARK[data], offsets) / chars,
        _per_text(_STOP[data], offsets) / tokens,
        _per_text(_DIGIT[data], offsets) / chars,
        _per_text(data >= 128, offsets) / chars,
        _per_text(data == 10, offsets) / tokens,
        np.bincount(owner, weights=same, minlength=len(counts)) / tokens,
        _distinct(hashes, words.first) / tokens,
        _distinct(pairs, words.first) / tokens,
        np.bincount(owner, weights=widths, minlength=len(counts)) / tokens / 10,
        np.log1p(counts) ** 2 / 100,
        long / tokens,
    ]
    return np.sqrt(np.maximum(np.stack(shares, axis=1), 0))


@dataclass
class Ranking:
    """Weights of standardised features, and the score at the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale @ self.weights

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Between 0 and 1, and ``ACCEPTED`` at the threshold."""
        shift = np.log(ACCEPTED / (1 - ACCEPTED))
        return 1 / (1 + np.exp(-np.clip(self.raw(features) - self.threshold + shift, -700, 700)))


def fit_ranking(features: np.ndarray, good: np.ndarray, seed: int = 0) -> Ranking:
    """Bradley-Terry weights from pairs of a good and a bad document, by Newton's method.

    Without documents of both labels there is nothing to prefer: all weights are zero and
    every text is at the threshold.
    """
    size = features.shape[1]
    mean = features.mean(0) if len(features) else np.zeros(size)
    scale = features.std(0) + 1e-9 if len(features) else np.ones(size)
    ranking = Ranking(mean, scale, np.zeros(size), 0.0)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return ranking
    draw = np.random.default_rng(seed)
    pairs = PAIRS_EACH * max(len(better), len(worse))
    standard = (features - mean) / scale
    # every document takes part in about as many pairs as any other of its label
    first = np.resize(draw.permutation(better), pairs)
    second = draw.permutation(np.resize(worse, pairs))
    gaps = standard[first] - standard[second]
    weights = np.zeros(size)
    for _ in range(ROUNDS):
        lost = 1 / (1 + np.exp(np.clip(gaps @ weights, -500, 500)))
        slope = gaps.T @ lost / pairs - PENALTY * weights
        curve = (gaps * (lost * (1 - lost))[:, None]).T @ gaps / pairs + PENALTY * np.eye(size)
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / np.linalg.norm(step))
        if np.abs(step).max() < 1e-8:
            break
    ranking.weights = weights
    ordered = np.sort(ranking.raw(features))
    cut = len(worse)
    ranking.threshold = float((ordered[cut - 1] + ordered[cut]) / 2)
    return ranking


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_OF == HELD_OUT


def learned_ranking(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Ranking:
    """The ranking fitted on at most ``most`` labelled rows, chosen by the hash of their id."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = usable.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    keyed = texts.select(
        F.xxhash64("doc_id").alias("first"),
        F.xxhash64("text").alias("then"),
        F.col("quality").cast("long").alias("quality"),
        "text",
    )

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [text_features(piece.column("text")) for piece in row_slices(batch, "text")]
        listed = pa.array(list(np.concatenate(parts)), pa.list_(pa.float64()))
        kept = [batch.column(name) for name in ("first", "then", "quality")]
        return pa.RecordBatch.from_arrays([*kept, listed], ["first", "then", "quality", "features"])

    # texts are measured where they are read: only a few numbers of each go to one place
    measured = map_arrow(keyed, measure, "first long, then long, quality long, features array<double>")
    rows = measured.orderBy("first", "then").limit(most).collect()
    features = np.array([row["features"] for row in rows], float).reshape(-1, len(FEATURES))
    return fit_ranking(features, np.array([row["quality"] == 1 for row in rows], bool))


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """Rows of ``docs`` with ``_score``: from 0 to 1, ``ACCEPTED`` or more for good ones.

    Only the text enters a score; null texts score as empty ones.  Labels other than 0 and 1
    are left out.  Other columns stay as they are; the new one gets underscores behind its name
    until no column has it.
    """
    ranking = broadcast(docs.sparkSession, learned_ranking(docs, labels, most))
    rows = docs.select(F.struct("*").alias("_row"), "text", F.lit(0.0).alias("_score"))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = received(ranking)
        parts = [model.scores(text_features(piece.column("text"))) for piece in row_slices(batch, "text")]
        at = batch.schema.get_field_index("_score")
        return batch.set_column(at, "_score", pa.array(np.concatenate(parts)))

    return map_arrow(rows, score, rows.schema).select("_row.*", F.col("_score").alias(unused(docs, "_score")))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents at or above the threshold, in the columns of ``docs``."""
    score = unused(docs, "_score")
    return quality_scores(docs, labels).filter(F.col(score) >= ACCEPTED).drop(score)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its score and whether it is accepted."""
    return quality_scores(docs.select("doc_id", "text"), labels).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= ACCEPTED).cast("int").alias("predicted"),
    )
