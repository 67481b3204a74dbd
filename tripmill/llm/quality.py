"""Quality grades by ordinal regression on hashed words.

A document's features are the hashes of its distinct words, of how its longer words begin,
of its runs of punctuation, and of a few shapes (shares of words in capitals, of punctuation and of distinct words, in
steps). All grades share one weight per feature; ordered thresholds cut the score into
grades: ``P(grade <= j) = 1 / (1 + exp(score - threshold[j]))``. The expected grade ranks
documents, and the probability of reaching a grade selects them.

The model is fitted on a bounded sample of graded documents, those with the smallest hash
of the key; the sample's features are collected. Scoring
reads every text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from tripmill.llm import text as T

#: Graded documents the model is fitted on, at most.
SAMPLE = 12_000
FEATURE_BITS = 18
STEM_BYTES = 5
ROUNDS, RATE, PENALTY = 150, 0.05, 1e-3
#: A document is selected if it reaches this grade with at least this probability.
GOOD, LEAST = 2, 0.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NOT_MARK = _LETTER | T.SEPARATOR
_SMALL = np.zeros(256, bool)
_SMALL[[*range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the distinct features of each text, one text after another, and where
    each text begins."""
    texts = len(offsets) - 1
    starts, ends, first = T.words(data, offsets, ~_LETTER)
    marks, mark_ends, first_mark = T.words(data, offsets, _NOT_MARK)
    mask = T.U64((1 << FEATURE_BITS) - 1)
    lower = T.ascii_lower(data)
    words = T.word_hashes(lower, starts, ends)
    longer = ends - starts > STEM_BYTES
    stems = T.mix(~T.word_hashes(lower, starts[longer], starts[longer] + STEM_BYTES))
    small = np.r_[0, np.cumsum(_SMALL[data])]
    capital = (small[ends] == small[starts]) & (ends - starts > 1)
    text = np.repeat(np.arange(texts), np.diff(first))
    word_features = text * (1 << FEATURE_BITS) + (words & mask).astype(np.int64)
    stem_features = text[longer] * (1 << FEATURE_BITS) + (stems & mask).astype(np.int64)
    mark_text = np.repeat(np.arange(texts), np.diff(first_mark))
    mark_hashes = T.mix(T.word_hashes(data, marks, mark_ends))
    mark_features = mark_text * (1 << FEATURE_BITS) + (mark_hashes & mask).astype(np.int64)
    count = np.maximum(np.diff(first), 1)
    word_features = np.unique(word_features)
    shares = [
        np.bincount(text[capital], minlength=texts) / count,
        np.diff(first_mark) / count,
        np.bincount(word_features >> FEATURE_BITS, minlength=texts) / count,
    ]
    shapes = []
    for kind, share in enumerate(shares):
        step = np.minimum((share * 8).astype(np.int64), 8)
        number = T.mix((np.int64(1000 * (kind + 1)) + step).astype(T.U64)) & mask
        shapes.append(np.arange(texts) * (1 << FEATURE_BITS) + number.astype(np.int64))
    every = np.unique(np.concatenate([word_features, stem_features, mark_features, *shapes]))
    return every & ((1 << FEATURE_BITS) - 1), np.searchsorted(every >> FEATURE_BITS, np.arange(texts + 1))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(self.weights[number], dtype=np.float64)]
        return sums[first[1:]] - sums[first[:-1]]

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Of each grade, a row per score."""
        upto = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -50, 50)))
        return np.diff(np.c_[np.zeros(len(score)), upto, np.ones(len(score))], axis=1)


def fit_rows(number: np.ndarray, first: np.ndarray, grade: np.ndarray, grades: int) -> Model:
    """Maximum likelihood with a quadratic penalty, by full gradients (Adam).

    Thresholds are the first one and positive steps, so they stay in order. A grade that
    has no document gets a threshold beside its neighbour's."""
    n = len(grade)
    weights, cuts = np.zeros(1 << FEATURE_BITS), np.r_[-1.0, np.zeros(grades - 2)]
    used = np.unique(number)
    place = np.searchsorted(used, number).astype(np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(first))
    value = np.r_[np.zeros(len(used)), cuts]
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, ROUNDS + 1):
        w, cut = value[: len(used)], value[len(used) :]
        steps = np.exp(cut[1:])
        thresholds = np.cumsum(np.r_[cut[0], steps])
        score = np.bincount(row, w[place], minlength=n)
        upto = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds[None, :], -50, 50)))
        slope = np.c_[np.zeros(n), upto * (1 - upto), np.zeros(n)]
        upto = np.c_[np.zeros(n), upto, np.ones(n)]
        chance = np.maximum(upto[np.arange(n), grade + 1] - upto[np.arange(n), grade], 1e-12)
        high, low = slope[np.arange(n), grade + 1], slope[np.arange(n), grade]
        by_score = (high - low) / chance / n  # of minus the log likelihood
        by_threshold = np.zeros(grades + 1)
        np.add.at(by_threshold, grade + 1, -high / chance / n)
        np.add.at(by_threshold, grade, low / chance / n)
        inner = by_threshold[1:grades]
        later = np.cumsum(inner[::-1])[::-1]
        gradient = np.r_[
            np.bincount(place, by_score[row], minlength=len(used)) + PENALTY * w, later[0], later[1:] * steps
        ]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        value = value - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights[used] = value[: len(used)]
    cut = value[len(used) :]
    return Model(weights, np.cumsum(np.r_[cut[0], np.exp(cut[1:])]))


SAMPLED = S.StructType([S.StructField("grade", S.IntegerType()), S.StructField("features", S.ArrayType(S.IntegerType()))])


def _sampled(batches, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            number, first = features(*T.raw(piece.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(number, pa.int32()))
            yield pa.RecordBatch.from_arrays([piece.column("grade"), lists], schema=schema)


def _arrow(schema: S.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def grade() -> Column:
    """Rating of a labelled document: 0 toxic, 1 not toxic but of low quality, 2 good.
    Null where the labels don't tell."""
    toxic, quality = F.col("toxic"), F.col("quality")
    return F.when(toxic == 1, 0).when((toxic == 0) & (quality == 0), 1).when((toxic == 0) & (quality == 1), 2)


def fit(
    docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", rating: str = "grade", grades: int = 3,
    sample: int = SAMPLE,
) -> Model | None:
    """Model of the ratings 0 to ``grades - 1``; None without any rating.

    Of the rated documents those with the smallest hash of the key are used, ``sample`` at
    most. Ratings that are null or out of range, and null keys, don't count; a key with
    several ratings counts with each, one with several rows with the row of the smallest hash
    of its text. Null texts count as empty. Runs jobs.
    """
    rated = ratings.select(F.col(key).alias("key"), F.col(rating).cast("int").alias("grade"))
    rated = rated.where(F.col("key").isNotNull() & F.col("grade").between(0, grades - 1))
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    there = rated.join(source.select("key"), "key", "left_semi")
    some = there.orderBy(F.xxhash64("key"), "key", "grade").limit(sample)  # bounded, so it can be sent to all tasks
    schema = _arrow(SAMPLED)
    one = F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0)))  # as many rows as ratings, however often a key is there
    chosen = source.join(F.broadcast(some), "key").groupBy("key", "grade").agg(one.alias("text")).select("text", "grade", "key")
    rows = chosen.mapInArrow(lambda it: _sampled(it, schema), SAMPLED).toArrow()
    if not rows.num_rows:
        return None
    lists = rows.column("features").combine_chunks()
    length = lists.value_lengths().to_numpy().astype(np.int64)
    number, marks = lists.flatten().to_numpy(), rows.column("grade").to_numpy().astype(np.int64)
    # in an order that doesn't depend on how tasks end
    starts = np.cumsum(length) - length
    order = np.lexsort((np.add.reduceat(number, starts) if len(number) else length, length, marks))
    number = T.gather(number, starts[order], length[order])
    del rows, lists
    return fit_rows(number, np.r_[0, np.cumsum(length[order])], marks[order], grades)


SCORES = (S.StructField("text", S.StringType()), S.StructField("expected_grade", S.DoubleType()),
          S.StructField("tail_probability", S.DoubleType()))


def _scored(batches, model, good: int, grades: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in T.pieces(batch, "text"):
            n = piece.num_rows
            if model.value is None:
                expected, tail = np.full(n, float(grades - 1)), np.ones(n)
            else:
                chances = model.value.probabilities(model.value.score(*features(*T.raw(piece.column("text")))))
                expected, tail = chances @ np.arange(grades), chances[:, good:].sum(axis=1)
            columns = [piece.column("row"), piece.column("text"), pa.array(expected), pa.array(tail)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def score(docs: DataFrame, model: Model | None, text: str = "text", grades: int = 3, good: int = GOOD) -> DataFrame:
    """Rows (row, text, expected_grade, tail_probability): the other columns as a struct,
    the expected grade and the probability of at least grade ``good``.

    Without a model nothing speaks against a document: it gets the highest grade with
    probability 1. A null text is scored as an empty one. Every row gives a row."""
    others = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    source = docs.select(row.alias("row"), F.col(text).alias("text"))
    out = S.StructType([source.schema["row"], *SCORES])
    schema = _arrow(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a weight per hashed feature, whatever the corpus
    return source.mapInArrow(lambda it: _scored(it, sent, good, grades, schema), out)


def select(docs: DataFrame, model: Model | None, text: str = "text", least: float = LEAST, **options) -> DataFrame:
    """``docs`` without those that reach the good grade with a probability below ``least``."""
    kept = score(docs, model, text, **options).where(F.col("tail_probability") >= least)
    return kept.select(*[F.col("text").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
