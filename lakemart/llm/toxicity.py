"""Operator 9: toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions on the presence
of events of a text (``labelled.events``). Each model after the first also gets the
earlier categories' log odds; for the rows it is fitted on these come from models that
did not see the row's fold, neither for their weights nor for the choice of events. The categories of ``labels`` are: low quality, toxic, both
at once. A document is rejected when its probability of the category ``toxic`` reaches
a level that is chosen on the out-of-fold probabilities (see ``decision_level``). The models are fitted on at most ``labelled.SAMPLE_ROWS`` labelled rows and
applied to every whole text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import llm_query, table
from lakemart.llm.labelled import (
    FOLDS, Columns, Presence, Sample, choose_events, kept_rows, labelled_events, newton_change, score_rows, training_tables,
    transposed,
)

CATEGORIES = ["low_quality", "toxic", "toxic_low_quality"]
TARGETS = ["IF(quality = 0, 1, 0)", "toxic", "IF(quality = 0 AND toxic = 1, 1, 0)"]
THRESHOLD = 0.5  # without labelled rows on both sides
FALSE_SHARE = 0.01
LEVELS = (0.2, 0.8)
RIDGE = 0.5
STEEPEST = 12.0  # log odds are held within this


def odds(x: np.ndarray | Columns, weights: np.ndarray) -> np.ndarray:
    return np.clip(x @ weights, -STEEPEST, STEEPEST)


def logistic(x: np.ndarray | Columns, y: np.ndarray) -> np.ndarray:
    """Weights by Newton steps; all but the first column (ones) are shrunk."""
    weights, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    ridge[0] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-odds(x, weights)))
        slope = transposed(x, y - p) - ridge * weights
        change = newton_change(x, p * (1 - p) + 1e-9, ridge, slope)
        weights = weights + np.clip(change, -4, 4)
        if np.abs(change).max() < 1e-6:
            break
    return weights


def fit_chain(sample: Sample, categories: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each category the hashes of its events, and weights: constant, earlier categories' log odds, events. And each
    sampled row's log odds of all categories by models whose events and weights come from the other folds."""
    models = []
    if not sample.n:
        return models, np.zeros((0, categories))
    earlier = np.ones((sample.n, 1))
    for j in range(categories):
        chosen, weights = _one_category(sample, earlier, j)
        models.append((sample.events[chosen], weights))
        unseen = np.zeros(sample.n)
        for k in range(FOLDS):
            out = sample.fold == k
            if out.any() and not out.all():
                chosen, weights = _one_category(sample.where(~out), earlier[~out], j)
                unseen[out] = odds(sample.where(out).columns(earlier[out], chosen), weights)
        earlier = np.column_stack([earlier, unseen])
    return models, earlier[:, 1:]


def _one_category(sample: Sample, earlier: np.ndarray, j: int) -> tuple[list[int], np.ndarray]:
    y = sample.y[:, j]

    def fit(x):
        weights = logistic(x, y)
        p = 1 / (1 + np.exp(-odds(x, weights)))
        return weights, y - p, p * (1 - p)
    chosen, x = choose_events(sample, fit, earlier)
    return chosen, logistic(x, y)


def decision_level(unseen: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on a document is rejected: the lowest at which, by the log odds of models that did not see
    the row, ``FALSE_SHARE`` of the rows outside the category at most are rejected, within ``LEVELS``."""
    clean = np.sort(unseen[y == 0])[::-1]
    if not len(clean) or len(clean) == len(y):
        return THRESHOLD
    allowed = clean[min(len(clean) - 1, int(FALSE_SHARE * len(clean)))]  # the first clean row that is not to be rejected
    return float(np.clip(1 / (1 + np.exp(-allowed)) + 1e-9, *LEVELS))


def fitted(train_docs: DataFrame, labels: DataFrame, targets: list[str] = TARGETS) -> tuple[list, list[float]]:
    """The models of a chain for ``targets`` (conditions on ``labels``), and the decision level of each."""
    sample = Sample(labelled_events(train_docs, labels, [F.expr(t) for t in targets]), len(targets))
    models, unseen = fit_chain(sample, len(targets))
    levels = [decision_level(unseen[:, j], sample.y[:, j]) if sample.n else THRESHOLD for j in range(len(targets))]
    return models, levels


def chain(docs: DataFrame, models: list, names: list[str], text: str = "text", keep: Callable | None = None) -> DataFrame:
    """All columns of ``docs`` and ``p_<name>`` for each category in order (see ``score_rows`` for ``keep``).

    Null and empty texts have no events; their probabilities are those of the constant.
    Without labelled rows all probabilities are 0. Repeated rows are rows like any other."""
    wanted = np.unique(np.concatenate([np.zeros(0, np.int64), *[m[0] for m in models]]))

    spread = []  # each model's weights of its dense columns, and of all wanted events
    for own, weights in models:
        dense = len(weights) - len(own)
        spread.append((weights[:dense], np.zeros(len(wanted))))
        spread[-1][1][np.searchsorted(wanted, own)] = weights[dense:]

    def predict(has: Presence) -> np.ndarray:
        if not spread:
            return np.zeros((has.n, len(names)))
        x = np.ones((has.n, 1))
        for dense, weights in spread:
            x = np.column_stack([x, np.clip(x @ dense + has @ weights, -STEEPEST, STEEPEST)])
        return 1 / (1 + np.exp(-x[:, 1:]))
    return score_rows(docs, wanted, [f"p_{n}" for n in names], predict, text, keep)


def toxicity(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, a probability for each category, ``toxic`` (rejected) for each row of ``docs``."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    models, levels = fitted(train_docs, labels)
    level = levels[CATEGORIES.index("toxic")]
    return chain(texts, models, CATEGORIES).drop("text").withColumn("toxic", F.col("p_toxic") >= F.lit(level))


def without_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its columns."""
    models, levels = fitted(train_docs, labels)
    place = CATEGORIES.index("toxic")
    level = levels[place]
    return kept_rows(docs, lambda rows, text: chain(rows, models, CATEGORIES, text, lambda p: p[:, place] < level))


@llm_query("op9_toxicity_chain")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; ``labels`` gives the categories."""
    return toxicity(table(spark, sf_dir, "documents"), *training_tables(spark, sf_dir))
