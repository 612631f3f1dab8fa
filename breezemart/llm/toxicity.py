"""Toxicity by class-conditional Kneser-Ney models over code points (`char_grams`).

A text's score comes from the difference of its log-likelihoods in a toxic and an ordinary model, per
code point, of the whole text and of its most toxic passage, through a logistic function.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breezemart.llm import char_grams
from breezemart.llm.char_grams import Texts
from breezemart.llm.shared import remove, staged

#: Labelled rows that the logistic weights are fitted on at most.
CALIBRATION_ROWS = 50_000
#: Weights of whole, peak and constant where the labels of fold 4, or of folds 1 to 3, lack a class and
#: nothing can be fitted: a text is toxic if its log ratio per code point is above zero.
UNFITTED = [10.0, 0.0, 0.0]


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic score over the features and a constant, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge @ w
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, slope)
    return w


class Model:
    """A fitted scorer: the written table of ratios and the weights of the two features."""

    def __init__(self, table: DataFrame | None, weights: list[float] | None, prior: float):
        self.table, self.weights, self.prior = table, weights, prior

    def score(self) -> Column:
        """Of the columns whole and peak."""
        raw = F.col("whole") * self.weights[0] + F.col("peak") * self.weights[1] + F.lit(self.weights[2])
        return 1 / (1 + F.exp(-F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def prepared(docs: DataFrame, carry: list[str] = ()) -> Texts:
    """The texts of `docs` (doc_id, text) and the columns of `carry`, written once for `fit` and `toxicity`."""
    others = {f"carry_{c}": F.col(c) for c in carry if c != "text"}
    texts = char_grams.chunked(docs, {"doc_id": F.col("doc_id"), **others})
    return Texts(texts.table, [*texts.carried, *(["_text"] if "text" in carry else [])], texts.path)


def fit(texts: Texts, labels: DataFrame) -> Model:
    """Learn from the labelled rows of folds 1 to 4 (crc32 of doc_id modulo 5).

    The logistic weights of the two ratios are fitted on fold 4 with counts of folds 1 to 3, on at most
    `CALIBRATION_ROWS` rows by the order of a hash of doc_id; the ratios kept then come from the counts of
    every labelled row of folds 1 to 4. A doc_id with several labels is toxic if any says so; rows without
    a label or a text teach nothing. Labels meet the rows' numbers, not their texts.
    """
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")).where(fold(F.col("doc_id")) != 0))
    later = (fold(F.col("doc_id")) == 4).cast("int")
    cells = staged(texts.table.select("_chunk", "_row", "doc_id").join(known, "doc_id").select(
        "_chunk", "_row", "doc_id", "toxic", (F.col("toxic") + 2 * later).cast("int").alias("cell")), "cells")
    counts = char_grams.count(texts, cells.select("_chunk", "_row", "cell"))
    n0, n1, n2, n3 = (bool(x) for x in counts.agg(*[F.sum(f"n{i}") for i in range(4)]).first())
    if not n0 + n2 or not n1 + n3:
        return Model(None, None, float(n1 + n3 > 0))
    weights = UNFITTED
    if n0 and n1 and n2 and n3:
        early = char_grams.ratios(counts, F.col("n0"), F.col("n1"))
        chosen = staged(cells.where("cell >= 2").orderBy(F.xxhash64("doc_id"), "doc_id", "_chunk", "_row")
                        .limit(CALIBRATION_ROWS).select("_chunk", "_row", "toxic"), "calibration")
        part = char_grams.subset(texts, chosen)
        seen = char_grams.scored(part, early).toPandas()
        remove(texts.table.sparkSession, part.path)
        weights = calibrate(seen[["whole", "peak"]].to_numpy(), seen["toxic"].to_numpy(float)).tolist()
    return Model(char_grams.ratios(counts, F.col("n0") + F.col("n2"), F.col("n1") + F.col("n3")), weights, 0.0)


def toxicity(texts: Texts, model: Model) -> DataFrame:
    """Every row of `texts` with doc_id, held_out, score, predicted and the carried columns.

    Only the text enters the score: the log-likelihood ratio of the toxic and the ordinary model per code
    point, and that of its most toxic passage. A null or empty text has ratio 0 and so the score of the
    constant alone. A null doc_id is not held out. Without labelled rows of both classes all scores are
    0, or 1 if only toxic ones are known. An empty table gives no rows.
    """
    carried = [c for c in texts.carried if c != "doc_id"]
    if model.weights is None:
        found = texts.table.withColumn("score", F.lit(model.prior))
    else:
        found = char_grams.scored(texts, model.table).withColumn("score", model.score())
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        *[F.col(c).alias("text" if c == "_text" else c.removeprefix("carry_")) for c in carried])
