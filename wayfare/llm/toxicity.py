"""Severity of toxic texts by cumulative-link (proportional odds) regression.

One weight for each word that matters, shared by all ordered thresholds:
P(grade > k) = sigmoid(score - threshold_k).  A text's features are the words it
has, whatever their number, so a few words in a very long text count in full.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordscan as ws

TRAIN_ROWS = 10_000     # labelled texts that the model is fitted on, at most
MIN_TEXTS = 3           # training texts that a word must be in
EPOCHS = 150
DEVIATIONS = 6.0
RIDGE = 1e-4
RATE = 0.5


@dataclass
class OrdinalModel:
    words: np.ndarray        # 64-bit hashes of the words with a weight, ascending
    weights: np.ndarray
    thresholds: np.ndarray   # ascending, one less than there are grades

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) of each row, by threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -30, 30)))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the words have a weight, and its place."""
        if not len(self.words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = np.flatnonzero(self.words[at] == hashes)
        return known, at[known]


def _features(column: pa.Array):
    """(first row, end row, hash of each word, first word of each row) of a text column."""
    for row, end, data, offsets in ws.text_slices(column):
        starts, ends, word_at = ws.find_words(data, offsets, ws.ALPHANUMERIC)
        yield row, end, ws.hash_words(data, starts, ends), word_at


def _thresholds(params: np.ndarray) -> np.ndarray:
    """Ascending thresholds from the first one and the logs of the steps between them."""
    return np.concatenate([[params[0]], params[0] + np.cumsum(np.exp(params[1:]))])


def _slopes(score: np.ndarray, grades: np.ndarray, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the mean negative log-likelihood: by each row's score (not divided), and by params."""
    # P(grade <= k), with 0 and 1 at the ends: a grade's chance is a difference of neighbours.
    rows, at = len(score), np.arange(len(score))
    below = 1 / (1 + np.exp(-np.clip(_thresholds(params)[None, :] - score[:, None], -30, 30)))
    below = np.hstack([np.zeros((rows, 1)), below, np.ones((rows, 1))])
    slope = below * (1 - below)
    chance = np.maximum(below[at, grades + 1] - below[at, grades], 1e-9)
    by_score = (slope[at, grades + 1] - slope[at, grades]) / chance
    by_threshold = np.zeros(below.shape[1])
    np.add.at(by_threshold, grades + 1, -slope[at, grades + 1] / chance)
    np.add.at(by_threshold, grades, slope[at, grades] / chance)
    after = np.cumsum(by_threshold[1:-1][::-1])[::-1] / max(1, rows)
    return by_score, np.concatenate([after[:1], after[1:] * np.exp(params[1:])])


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, epochs: int = EPOCHS,
                min_texts: int = MIN_TEXTS) -> OrdinalModel:
    """Fit shared weights and ordered thresholds; ``rows``: distinct word hashes of each text.

    First a lasso, its penalty ``DEVIATIONS`` times the standard deviation that a
    meaningless feature's gradient has, chooses the features; then they are fitted
    again with a small ridge only.
    """
    n = max(1, len(rows))
    share = np.array([(grades <= k).mean() if len(grades) else 0.5 for k in range(n_grades - 1)]).clip(1e-3, 1 - 1e-3)
    logits = np.log(share / (1 - share))
    params = np.concatenate([logits[:1], np.log(np.maximum(np.diff(logits), 1e-2))])
    words, flat, texts = np.unique(np.concatenate(rows) if rows else np.empty(0, np.uint64),
                                   return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    common = texts[flat] >= min_texts
    flat, owner, features = flat[common], owner[common], len(words)
    spread = np.sqrt(np.bincount(flat, minlength=features) / n)
    weights = np.zeros(features)
    noise = _slopes(np.zeros(len(rows)), grades, params)[0].std() / np.sqrt(n) if rows else 0.0
    for penalty, ridge, rounds in ((DEVIATIONS * noise, 0.0, epochs), (0.0, RIDGE, 8 * epochs)):
        if not penalty:  # the second fit is on the features that the first one chose
            chosen = weights[flat] != 0
            flat, owner = flat[chosen], owner[chosen]
        used = np.unique(flat)
        scale = 1 / spread[used]
        column = np.searchsorted(used, flat)
        own = np.zeros(len(used))
        squares, param_squares = np.full(len(used), 1e-8), np.full(len(params), 1e-8)
        for _ in range(rounds):
            score = np.bincount(owner, weights=(own * scale)[column], minlength=len(rows))
            by_score, by_params = _slopes(score, grades, params)
            slope = np.bincount(column, weights=by_score[owner], minlength=len(used)) * scale / n + ridge * own
            squares += slope * slope
            param_squares += by_params * by_params
            step = RATE / np.sqrt(squares)
            own -= step * slope
            own = np.sign(own) * np.maximum(np.abs(own) - step * penalty, 0)
            params = params - RATE * by_params / np.sqrt(param_squares)
        weights = np.zeros(features)
        weights[used] = own * scale
    kept = np.flatnonzero(weights)
    return OrdinalModel(words[kept], weights[kept], _thresholds(params))


def train_severity(docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", id_col: str = "doc_id",
                   text_col: str = "text", rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` labelled texts, chosen by the hash of their id.

    Grades are 0, 1, ...; rows with a null id, text or grade are left out.  A
    text's features go to the driver as its distinct word hashes, so the driver
    holds ``rows`` texts' words: of rows that share an id one counts (the smallest
    features in byte order).  Without labelled texts everything gets grade 0.
    """
    graded = (labels.select(F.col(id_col).alias("doc_id"), F.col(grade_col).cast("int").alias("grade"))
              .dropna().groupBy("doc_id").agg(F.max("grade").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropna()

    def scan(batches):
        for batch in batches:
            words: list[bytes] = []
            for row, end, ids, word_at in _features(batch.column(1)):
                words += [np.unique(ids[word_at[k]:word_at[k + 1]]).tobytes() for k in range(end - row)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), batch.column(2)],
                                             names=["grade", "words", "doc_id"])

    # At most ``rows`` narrow rows are broadcast, and at most as many come back.
    joined = texts.join(F.broadcast(graded), "doc_id").select("grade", "text", "doc_id")
    fields = f"grade int, words binary, doc_id {joined.schema['doc_id'].dataType.simpleString()}"
    one_each = joined.mapInArrow(scan, fields).groupBy("doc_id", "grade").agg(F.min("words").alias("words"))
    found = one_each.select("grade", "words").toPandas().sort_values(["grade", "words"])
    grades = found["grade"].to_numpy(np.int64)
    return fit_ordinal([np.frombuffer(w, np.uint64) for w in found["words"]], grades,
                       max(2, int(grades.max(initial=1)) + 1))


def score_severity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Expected severity of each whole text.

    Null and empty texts, and texts without words, have no features and get what
    the thresholds alone say.  Repeated words count once; repeated rows stay;
    other columns are not looked at; an empty table gives an empty result.

    Returns doc_id, severity (expected grade), grade (the most likely one; the
    lower of equals), p_toxic (chance of any grade above 0), toxic (that chance
    is above one half).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The model holds words of a bounded sample.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "severity double, grade int, p_toxic double, toxic boolean")])

    def scan(batches):
        fitted = shared.value
        for batch in batches:
            chances = [np.empty((0, len(fitted.thresholds)))]
            for row, end, hashes, word_at in _features(batch.column(1)):
                # A word counts once in a text: keep the first of each (text, word).
                owner = np.repeat(np.arange(end - row), np.diff(word_at))
                known, word = fitted.find(hashes)
                pairs = np.unique(owner[known] * len(fitted.words) + word)
                owner, word = np.divmod(pairs, max(1, len(fitted.words)))
                score = np.bincount(owner, weights=fitted.weights[word], minlength=end - row)
                chances.append(fitted.above(score))
            above = np.concatenate(chances)
            each = -np.diff(np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0].copy()), pa.array(above[:, 0] > 0.5)], names=fields.names)

    return docs.mapInArrow(scan, fields)

