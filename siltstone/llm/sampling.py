"""Bounded samples of rows to learn from, and a small calibrated logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_SPAN = 1 << 30


def _some(ids: DataFrame, total: int, rows: int, salt: int) -> list[int]:
    """At most `rows` of the ids `i`, those of least hash. total: how many there are.

    A threshold on the hash lets hardly more than `rows` through on the
    executors, so what comes to the driver does not grow with the table.
    """
    h = F.pmod(F.xxhash64(F.lit(salt), "i"), F.lit(_SPAN))
    if total > rows:
        ids = ids.where(h < int(_SPAN * min(1.0, (rows + 8 * rows**0.5 + 16) / total)))
    got = ids.select("i", h.alias("h")).distinct().collect()
    return [r["i"] for r in sorted(got, key=lambda r: (r["h"], r["i"]))[:rows]]


def _texts(docs: DataFrame, ids: list[int], text: str, doc_id: str) -> dict[int, str]:
    """The text of each id; of rows that repeat an id the least text, of null texts the empty one."""
    spark = docs.sparkSession
    if not ids:
        return {}
    # as many rows as were sampled: a bounded broadcast
    chosen = F.broadcast(spark.createDataFrame([(i,) for i in ids], "i long"))
    own = docs.select(F.col(doc_id).cast("long").alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).join(chosen, "i")
    return {r["i"]: r["t"] for r in own.groupBy("i").agg(F.min("t").alias("t")).collect()}


def labelled(labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id") -> DataFrame:
    """(i, y) of the labels that `learn` allows: a null id or label is left out, a repeated id counts once, by its greatest label."""
    own = labels.select(F.col(doc_id).cast("long").alias("i"), F.col(label).cast("int").alias("y")).where("i IS NOT NULL AND y IN (0, 1)").groupBy("i").agg(F.max("y").alias("y"))
    return own.withColumn("doc_id", F.col("i")).where(learn).select("i", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, text: str = "text", doc_id: str = "doc_id", classes: tuple[int, ...] = (0, 1)) -> tuple[list[tuple[str, int]], float]:
    """(text, label) of at most `rows` labelled rows of each class, chosen by a hash of the id, in order of id; and label 1's share of all labels that `learn` allows.

    Labels are cut to the sample first; only the sampled documents' whole texts
    come to the driver.
    """
    own = labelled(labels, label, learn, doc_id)
    n = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    y = {i: c for c in classes if c in n for i in _some(own.where(F.col("y") == c), n[c], rows, 0)}
    texts = _texts(docs, sorted(y), text, doc_id)
    return [(texts[i], y[i]) for i in sorted(texts)], n.get(1, 0) / max(1, sum(n.values()))


def text_sample(docs: DataFrame, learn: Column, rows: int, text: str = "text", doc_id: str = "doc_id") -> list[str]:
    """Whole texts of at most `rows` documents that `learn` allows, chosen by a hash of the id, whatever their label; null ids are left out."""
    ids = docs.select(F.col(doc_id).cast("long").alias("i")).where("i IS NOT NULL").withColumn("doc_id", F.col("i")).where(learn).select("i")
    texts = _texts(docs, _some(ids, ids.count(), rows, 1), text, doc_id)
    return [texts[i] for i in sorted(texts)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on x (n by k) with an intercept last, by Newton's method."""
    a = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * w
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-9:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
