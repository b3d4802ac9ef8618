"""Toxicity: cumulative-link ordinal regression over sparse text features.

A text's features are the words it holds and their beginnings, so that inflected
forms share weight. The model gives ``P(grade > k) = sigmoid(w . x - t_k)`` with one
weight vector for all thresholds ``t_0 < t_1 < ...``; the expected severity is the
sum of these over ``k``.

Fitting takes a bounded sample of the labelled rows: ``max_labelled`` of them, the
first by a hash of their id. Of their features all take part that tell grades apart by a
statistic; there is no limit to their number but that of the labelled rows. Everything
else covers all rows and whole texts. NULL and empty texts
have no feature and get the score of an empty text. Labels without a grade, and ids
without a document, take no part; an id that is labelled twice keeps its highest
grade, one that several documents have is learnt from the first of their texts in
order, and repeated documents are scored row by row. Without labels of two grades
every text is scored as the lowest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellgauge.llm.common import changed_rows, staged, text_slices, texts_of

_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5, 6)
_CACHED_WORDS = 1 << 18


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_features(word: str) -> list[str]:
    """The word, and its beginnings marked as such."""
    return [word, *(f"{word[:n]}-" for n in _BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class OrdinalModel:
    """Weights by feature, shared by all thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (0.0,)

    def exceed(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) in column k."""
        return _sigmoid(np.asarray(score)[:, None] - np.array(self.thresholds)[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


# --- fitting -------------------------------------------------------------------


def _loss(params, rows, columns, grades, n_features, n_cuts, l2):
    """Negative log likelihood with its gradient. Thresholds are the first one and
    the logarithms of the steps between them, so they stay in order."""
    w, first, steps = params[:n_features], params[n_features], np.exp(params[n_features + 1 :])
    cuts = first + np.concatenate([[0.0], np.cumsum(steps)])
    n = len(grades)
    score = np.bincount(rows, w[columns], n)
    bounds = np.concatenate([[-np.inf], cuts, [np.inf]])
    upper, lower = _sigmoid(bounds[grades + 1] - score), _sigmoid(bounds[grades] - score)
    p = np.maximum(upper - lower, 1e-12)
    du, dl = upper * (1 - upper), lower * (1 - lower)
    d_score = (du - dl) / p  # of the negative log likelihood
    d_cuts = np.zeros(n_cuts + 2)
    np.add.at(d_cuts, grades + 1, -du / p)
    np.add.at(d_cuts, grades, dl / p)
    d_cuts = d_cuts[1:-1]
    d_w = np.bincount(columns, d_score[rows], n_features) + l2 * w
    tail = np.cumsum(d_cuts[::-1])[::-1]
    gradient = np.concatenate([d_w, [d_cuts.sum()], tail[1:] * steps])
    return -np.log(p).sum() + 0.5 * l2 * (w @ w), gradient


def _minimise(f, x, steps=200, memory=10):
    """Limited-memory quasi-Newton steps with backtracking."""
    value, gradient = f(x)
    moves, turns = [], []
    for _ in range(steps):
        q, kept = gradient.copy(), []
        for s, y in zip(reversed(moves), reversed(turns), strict=True):
            a = (s @ q) / (s @ y)
            q -= a * y
            kept.append(a)
        if moves:
            q *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
        else:
            q /= max(1.0, np.abs(gradient).max())
        for s, y, a in zip(moves, turns, reversed(kept), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        length, slope = 1.0, -(gradient @ q)
        while length > 1e-10:
            new_x = x - length * q
            new_value, new_gradient = f(new_x)
            if new_value <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        move, turn = new_x - x, new_gradient - gradient
        if move @ turn > 1e-12:
            moves, turns = [*moves, move][-memory:], [*turns, turn][-memory:]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, gradient = new_x, new_value, new_gradient
        if done:
            break
    return x


def fit_ordinal(
    vectors: list[np.ndarray], grades: np.ndarray, features: list[str], l2: float = 0.3
) -> OrdinalModel:
    """Fit on feature indices per row and grades 0, 1, ... (each below the highest
    should occur)."""
    n_cuts = int(grades.max()) if len(grades) else 0
    if n_cuts < 1 or grades.min() > 0:
        return OrdinalModel({}, (40.0,))
    rows = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
    columns = np.concatenate([np.zeros(0, np.int64), *vectors]).astype(np.int64)
    start = np.zeros(len(features) + n_cuts)
    start[len(features)] = np.log((grades == 0).sum() / (grades > 0).sum())
    found = _minimise(
        lambda x: _loss(x, rows, columns, grades, len(features), n_cuts, l2), start
    )
    w, first, steps = found[: len(features)], found[len(features)], found[len(features) + 1 :]
    cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    return OrdinalModel(
        {f: float(x) for f, x in zip(features, w, strict=True) if x}, tuple(cuts.tolist())
    )


def by_strength(vectors: list[np.ndarray], positive: np.ndarray, markers: np.ndarray):
    """Grades 0, 1, 2 from yes/no labels: rows labelled yes that hold more distinct
    markers than their median are grade 2."""
    held = np.array([np.isin(v, markers).sum() for v in vectors], np.int64)
    grades = (positive > 0).astype(np.int64)
    if grades.any():
        grades[(grades == 1) & (held > np.median(held[grades == 1]))] = 2
    return grades


def train(
    docs: DataFrame,
    labels: DataFrame,
    grade_column: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_labelled: int = 20_000,
    min_association: float = 10.83,
    min_texts: int = 3,
    split_yes: bool = False,
) -> OrdinalModel:
    """Fit on documents with a grade. Features need a chi-squared statistic of
    ``min_association``, whose default has one chance in a thousand, and ``min_texts``
    labelled texts that hold them, since the statistic means nothing for fewer. With
    ``split_yes`` the label is yes or no, and yes is split into two grades by how many
    telling features a text holds.
    """
    graded = (
        labels.groupBy(F.col(id_column).alias("_id"))
        .agg(F.max(F.col(grade_column).cast("int")).alias("_grade"))
        .filter("_id is not null and _grade is not null")
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_labelled)
    )
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    sample = (
        texts.join(F.broadcast(graded), "_id")  # max_labelled rows at most
        .groupBy("_id")
        .agg(F.min("_text").alias("_text"), F.max("_grade").alias("_grade"))
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text"):
            held = [
                sorted({f for w in set(words(t.decode("utf-8", "replace"))) for f in word_features(w)})
                for t in texts_of(batch, "_text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_grade"), pa.array(held, pa.list_(pa.string()))],
                names=["_id", "_grade", "features"],
            )

    id_kind = docs.schema[id_column].dataType.simpleString()
    featured = staged(
        sample.mapInArrow(featurise, f"_id {id_kind}, _grade int, features array<string>"),
        "labelled-features",
    )
    totals = featured.agg(F.count(F.lit(1)), F.count_if(F.col("_grade") > 0)).first()
    if not totals[1] or totals[0] == totals[1]:
        return OrdinalModel({}, (40.0,))
    n, n_yes = totals
    yes, no = F.col("yes"), F.col("n") - F.col("yes")
    # Association of presence with a grade above 0, as a chi-squared statistic.
    d = (no * (n_yes - yes) - yes * (n - n_yes - no)).cast("double")
    spread = (F.col("n") * (n - F.col("n"))).cast("double") * float(n_yes * (n - n_yes)) / n
    chosen = (
        featured.select("_grade", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_grade") > 0).alias("yes"))
        .withColumn("weight", F.try_divide(d * d, spread))
        .filter((F.col("n") >= min_texts) & (F.col("weight") >= min_association))
        .withColumn("marker", (yes / n_yes > 20 * (no + 0.5) / (n - n_yes)))
        .orderBy(F.desc("weight"), "feature")
        .select("feature", "marker")
        .collect()  # features of max_labelled texts
    )
    features = [r.feature for r in chosen]
    place = {f: i for i, f in enumerate(features)}
    markers = np.array([i for i, r in enumerate(chosen) if r.marker], np.int64)

    def indices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [
                [place[f] for f in row if f in place] for row in batch.column("features").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_grade"), pa.array(held, pa.list_(pa.int32()))],
                names=["_grade", "held"],
            )

    # max_labelled rows, with the chosen features they hold.
    rows = featured.mapInArrow(indices, "_grade int, held array<int>").toArrow()
    vectors = [np.array(v, np.int64) for v in rows.column("held").to_pylist()]
    grades = rows.column("_grade").to_numpy().astype(np.int64)
    if split_yes:
        grades = by_strength(vectors, grades, markers)
    return fit_ordinal(vectors, grades, features)


# --- scoring -------------------------------------------------------------------


class _Known(dict):
    """Numbers of a word's features that the model knows."""

    def __init__(self, place: dict[str, int]):
        super().__init__()
        self.place = place

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.place[f] for f in word_features(word) if f in self.place)
        if len(self) < _CACHED_WORDS:
            self[word] = found
        return found


class _Scorer:
    def __init__(self, model: OrdinalModel):
        self.model = model
        self.weights = list(model.weights.values())
        self.known = _Known({f: i for i, f in enumerate(model.weights)})

    def exceed(self, texts: list[bytes]) -> np.ndarray:
        totals = []
        for text in texts:
            held: set[int] = set()
            for word in set(words(text.decode("utf-8", "replace"))):
                held.update(self.known[word])
            totals.append(sum(self.weights[i] for i in sorted(held)))
        return self.model.exceed(np.array(totals, np.float64))


def score(
    docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: the id, ``expected_severity``, ``grade`` (the most likely) and
    ``p_toxic``, the probability of a grade above 0. No shuffle; the model goes to
    every task, and its weights are some of the features of the texts it was fitted on."""
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in text_slices(batches, text_column):
            exceed = scorer.exceed(texts_of(batch, text_column))
            each = -np.diff(exceed, axis=1, prepend=1.0, append=0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    pa.array(exceed.sum(axis=1)),
                    pa.array(each.argmax(axis=1).astype(np.int32)),
                    pa.array(exceed[:, 0].copy()),
                ],
                names=[id_column, "expected_severity", "grade", "p_toxic"],
            )

    return docs.select(id_column, text_column).mapInArrow(
        rows, f"`{id_column}` {kind}, expected_severity double, grade int, p_toxic double"
    )


def without_toxic(
    docs: DataFrame, model: OrdinalModel, threshold: float = 0.5, text_column: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose probability of a grade above 0 is
    ``threshold`` at most."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in text_slices(batches, text_column):
            toxic = scorer.exceed(texts_of(batch, text_column))[:, 0]
            yield batch.filter(pa.array(toxic <= threshold))

    return changed_rows(docs, rows)
