"""Operator 4: quality by ordinal cumulative-link regression.

Ratings have ordered grades. One linear predictor on the text's hashed events
(``labelled.events``) serves all grades; ordered thresholds part them:

    P(grade >= g) = logistic(predictor - threshold[g])

The model gives the expected grade and the tail probability P(grade >= 1) by which documents are
selected. Grades of ``labels``: 0 low quality; 1 good but toxic; 2 good and not toxic.
The model is fitted on at most ``labelled.SAMPLE_ROWS`` labelled rows and applied to every whole text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.labelled import (
    Columns, Presence, Sample, choose_events, kept_rows, labelled_events, newton_change, score_rows, training_tables, transposed,
)

GRADE = "CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 2 END"
GRADES = 3
TAIL = 0.5
RIDGE = 0.5
STEEPEST = 30.0  # log odds are held within this


def _logistic(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -STEEPEST, STEEPEST)))


class OrdinalModel:
    """Weights shared by all grades and ordered thresholds, by damped Newton steps."""

    def __init__(self, grades: int):
        self.grades, self.weights, self.thresholds = grades, np.zeros(0), np.zeros(grades - 1)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= g) for g = 1 .. grades - 1."""
        return _logistic(score[:, None] - self.thresholds[None])

    def _slopes(self, score: np.ndarray, y: np.ndarray):
        """Log likelihood, and each row's slope and curvature in its upper and lower limit."""
        edge = np.concatenate([[-np.inf], self.thresholds, [np.inf]])
        with np.errstate(over="ignore", invalid="ignore"):
            low, high = score - edge[y], score - edge[y + 1]  # grade y: between these limits
            a, b = np.where(np.isinf(low), 1.0, _logistic(low)), np.where(np.isinf(high), 0.0, _logistic(high))
        p = np.maximum(a - b, 1e-12)
        return np.log(p), a * (1 - a), b * (1 - b), p, a, b

    def fit(self, x: np.ndarray | Columns, y: np.ndarray):
        n, k = x.shape
        share = np.bincount(y, minlength=self.grades) + 0.5
        below = np.cumsum(share)[:-1] / share.sum()
        known = self.weights[:k]  # columns are only added: go on from the last fit
        if not len(known):
            self.thresholds = np.log(below / (1 - below))
        self.weights = np.concatenate([known, np.zeros(k - len(known))])
        value = self._value(x, y)
        step = 1.0
        for _ in range(60):
            _, da, db, p, a, b = self._slopes(x @ self.weights, y)
            slope = (da - db) / p
            curve = np.maximum(slope**2 - (da * (1 - 2 * a) - db * (1 - 2 * b)) / p, 1e-6)
            gradient = transposed(x, slope) - RIDGE * self.weights
            change = newton_change(x, curve, np.full(k, RIDGE), gradient) if k else np.zeros(0)
            # the thresholds' own slopes: a row's lower limit is threshold[y - 1], its upper threshold[y]
            up, curve_up = np.zeros(self.grades + 1), np.full(self.grades + 1, 1e-3)
            np.add.at(up, y, -da / p)
            np.add.at(up, y + 1, db / p)
            np.add.at(curve_up, y, (da / p) ** 2 + da / p)
            np.add.at(curve_up, y + 1, (db / p) ** 2 + db / p)
            shift = (up / curve_up)[1:-1]
            old = self.weights, self.thresholds
            while step > 1e-4:
                self.weights = old[0] + step * np.clip(change, -3, 3)
                self.thresholds = np.maximum.accumulate(old[1] + step * np.clip(shift, -1, 1) + 1e-6 * np.arange(self.grades - 1))
                new = self._value(x, y)
                if new > value:
                    break
                step /= 2
            else:
                self.weights, self.thresholds = old
                break
            done = new - value < 1e-6 * n
            value, step = new, min(1.0, 2 * step)
            if done:
                break
        _, da, db, p, a, b = self._slopes(x @ self.weights, y)
        slope = (da - db) / p
        return self, slope, np.maximum(slope**2, 1e-3)

    def _value(self, x: np.ndarray | Columns, y: np.ndarray) -> float:
        return float(self._slopes(x @ self.weights, y)[0].sum() - RIDGE / 2 * (self.weights**2).sum())


def grade_documents(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, grade: str = GRADE,
                    grades: int = GRADES, text: str = "text", keep: Callable | None = None) -> DataFrame:
    """All columns of ``docs`` and ``expected_grade``, ``p_tail`` (see ``score_rows`` for ``keep``).

    Null and empty texts have no events: their grade is that of the thresholds alone.
    Without labelled rows every document has the highest grade. Repeated rows are rows like any other."""
    tails = [F.expr(f"IF(({grade}) >= {g}, 1, IF(({grade}) < {g}, 0, NULL))") for g in range(1, grades)]
    sample = Sample(labelled_events(train_docs, labels, tails), grades - 1)
    wanted, weights, model = np.zeros(0, np.int64), np.zeros(0), None
    if sample.n:
        y = sample.y.sum(1).astype(np.int64)
        model = OrdinalModel(grades)
        chosen, x = choose_events(sample, lambda x: model.fit(x, y), np.zeros((sample.n, 0)))
        model.fit(x, y)
        order = np.argsort(sample.events[chosen])
        wanted, weights = sample.events[chosen][order], model.weights[order]

    def predict(has: Presence) -> np.ndarray:
        if model is None:
            return np.tile([grades - 1.0, 1.0], (has.n, 1))
        p = model.tails(has @ weights)
        return np.column_stack([p.sum(1), p[:, 0]])
    return score_rows(docs, wanted, ["expected_grade", "p_tail"], predict, text, keep)


def quality(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, expected_grade, p_tail, kept`` for each row of ``docs``."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return grade_documents(texts, train_docs, labels).drop("text").withColumn("kept", F.col("p_tail") >= TAIL)


def good_documents(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    return kept_rows(docs, lambda rows, text: grade_documents(rows, train_docs, labels, text=text, keep=lambda v: v[:, 1] >= TAIL))


@llm_query("op4_ordinal_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; grades from ``labels``."""
    return quality(table(spark, sf_dir, "documents"), *training_tables(spark, sf_dir))
