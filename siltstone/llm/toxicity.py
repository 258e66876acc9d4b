"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words, word beginnings and how often they recur is
trained from confirmed toxic texts (P) and a sample of all documents (U), of
which no label is read, with the class prior pi. Its risk is
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)): where the second term, an estimate
of the negatives' risk, would fall below zero, the step goes against it, so the
model does not learn the unlabelled texts by heart. The loss is logistic, so
the model's output is the log odds of being toxic at that prior.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, read
from .sampling import labelled_sample, sigmoid, text_sample

#: Confirmed rows, and documents whatever their label, that are learnt from, at most.
SAMPLE_ROWS, UNLABELLED_ROWS = 3000, 6000
#: A feature counts if as many confirmed texts hold it, and their share lies so many standard deviations above that of U: by chance one feature in 300,000 does.
LEAST_DOCS, LEAST_Z = 3, 4.5
STEPS, RATE, DECAY, REMEMBERED = 150, 0.05, 1e-3, 1_000_000
#: A part that occurs once, twice, thrice or more in a text is one, two or three features.
TIMES = 3
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def parts(word: str) -> list[str]:
    """The parts of a word: itself and its beginnings of 4 to 7 letters."""
    return [word + "$"] + [word[:k] for k in range(4, 8) if len(word) >= k]


def coded(text: str | None, rows: dict[str, int]) -> np.ndarray:
    """The features of a text, in order: row * TIMES + t - 1 for each part that has a row, and each t up to the number of its occurrences."""
    n: dict[int, int] = {}
    for word, k in words(text).items():
        for p in parts(word):
            if (r := rows.get(p)) is not None:
                n[r] = n.get(r, 0) + k
    return np.array(sorted(r * TIMES + t for r, k in n.items() for t in range(min(k, TIMES))), dtype=np.int32)


@dataclass
class Model:
    #: part -> row of weights; weights[row, t - 1] is added where the part occurs t times or more
    rows: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None], known: dict[str, tuple]) -> np.ndarray:
        """known: remembers words' rows; bounded."""
        out = np.empty(len(texts))
        get, total = self.rows.get, np.cumsum(self.weights, axis=1).tolist()
        for i, t in enumerate(texts):
            mine: dict[int, int] = {}
            for x, n in words(t).items():
                f = known.get(x)
                if f is None:
                    f = known[x] = tuple(k for p in parts(x) if (k := get(p)) is not None)
                for k in f:
                    mine[k] = mine.get(k, 0) + n
            out[i] = self.bias + sum(total[k][min(mine[k], TIMES) - 1] for k in sorted(mine))
            if len(known) > REMEMBERED:
                known.clear()
        return sigmoid(out)


def _rows(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(sets).astype(np.int64), np.repeat(np.arange(len(sets)), [len(s) for s in sets])


def risk(fp: np.ndarray, fu: np.ndarray, prior: float) -> tuple[float, float]:
    """The positives' part pi * R_p(+), and the estimate R_u(-) - pi * R_p(-) of the negatives', of outputs on P and U under logistic loss."""
    # losses: l(+) = log(1 + exp(-f)), l(-) = log(1 + exp(f))
    return prior * np.logaddexp(0, -fp).mean(), np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()


def nnpu(pos: list[np.ndarray], unl: list[np.ndarray], n: int, prior: float, steps: int = STEPS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model under the non-negative risk with logistic loss, by Adam on whole passes."""
    (pi, pr), (ui, ur) = _rows(pos), _rows(unl)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        g = gradient(w, (pi, pr, len(pos)), (ui, ur, len(unl)), prior)
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def gradient(w: np.ndarray, pos: tuple, unl: tuple, prior: float) -> np.ndarray:
    """Of the risk at w, the bias last; where the negatives' estimate is below zero, its gradient alone, turned round. pos, unl: features, their rows, number of rows."""

    def out(i, r, rows):
        return np.bincount(r, w[i], rows) + w[-1]

    def back(i, r, g):
        full = np.bincount(i, g[r], len(w))
        full[-1] = g.sum()
        return full

    fp, fu = out(*pos), out(*unl)
    minus = back(*unl[:2], sigmoid(fu) / unl[2]) - back(*pos[:2], prior * sigmoid(fp) / pos[2])
    if risk(fp, fu, prior)[1] < 0:
        return -minus
    return back(*pos[:2], -prior * sigmoid(-fp) / pos[2]) + minus


def chosen_features(pos: list[np.ndarray], unl: list[np.ndarray], n: int, least_docs: int = LEAST_DOCS, least_z: float = LEAST_Z) -> np.ndarray:
    """Of n features those whose share of P lies far above that of U, in order."""
    hot, seen = (np.bincount(_rows(s)[0], minlength=n) for s in (pos, unl))
    a, b, both = hot / len(pos), seen / len(unl), (hot + seen) / (len(pos) + len(unl))
    return np.flatnonzero((hot >= least_docs) & (a - b > least_z * np.sqrt(both * (1 - both) * (1 / len(pos) + 1 / len(unl)))))


def fit(confirmed: list[str], unlabelled: list[str], prior: float) -> Model:
    """Of nothing confirmed, nothing unlabelled or no feature: the prior, for any text."""
    prior = float(np.clip(prior, 0.005, 0.5))
    none = Model({}, np.empty((0, TIMES)), float(np.log(prior / (1 - prior))))
    if not confirmed or not unlabelled:
        return none
    held: Counter = Counter()
    for t in confirmed:
        held.update({p for w in words(t) for p in parts(w)})
    rows = {p: k for k, p in enumerate(sorted(p for p, n in held.items() if n >= LEAST_DOCS))}
    del held
    pos, unl = [coded(t, rows) for t in confirmed], [coded(t, rows) for t in unlabelled]
    chosen = chosen_features(pos, unl, len(rows) * TIMES)
    if not len(chosen):
        return none
    place = np.full(len(rows) * TIMES, -1)
    place[chosen] = np.arange(len(chosen))
    pos, unl = ([k[k >= 0] for k in (place[s] for s in sets)] for sets in (pos, unl))
    w, bias = nnpu(pos, unl, len(chosen), prior)
    weights = np.zeros(len(rows) * TIMES)
    weights[chosen] = w
    weights = weights.reshape(-1, TIMES)
    used = {k: i for i, k in enumerate(np.unique(chosen // TIMES).tolist())}
    return Model({p: used[k] for p, k in rows.items() if k in used}, weights[list(used)], bias)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """A model from at most sample_rows confirmed texts and unlabelled_rows documents drawn without regard to labels, all with crc32(doc_id) mod 4 not 2.

    The class prior is the confirmed share of all such labels: the only use of
    a label 0.
    """
    may = crc_mod(F.col("doc_id"), 4) != 2
    sample, prior = labelled_sample(docs, labels, "toxic", may, sample_rows, text, doc_id, classes=(1,))
    return fit([t for t, _ in sample], text_sample(docs, may, unlabelled_rows, text, doc_id), prior)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs without text, with `score` (0 to 1); a null text is scored as an empty one. Each row alone; `score` is replaced."""
    rest = [c for c in docs.columns if c not in (text, "score")]
    own = docs.select(F.col(text).cast("string").alias("t"), F.struct(F.lit(0).alias("__none"), *rest).alias("rest"))

    def run(batches):
        known: dict[str, tuple] = {}
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.score(b.column(0).to_pylist(), known)), b.column(1)], names=["score", "rest"])

    out = own.mapInArrow(run, f"score double, rest {own.schema['rest'].dataType.simpleString()}")
    return out.select(*[F.col("rest").getField(c).alias(c) for c in rest], "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, learn(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
