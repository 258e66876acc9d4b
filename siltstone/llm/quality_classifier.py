"""Quality classifier by compression.

One zstandard dictionary is trained from good and one from bad labelled text. A
text is compressed with each, in pieces, so that the dictionary, not the text's
own past, decides; the difference of the two sizes, normalised by the text's
size and by the sizes' sum, is calibrated to a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, read
from .sampling import labelled_sample, logistic, sigmoid

#: Labelled rows of each class that are learnt from, at most.
SAMPLE_ROWS = 2000
DICT_BYTES, PIECE, LEVEL = 1 << 16, 4096, 3
THRESHOLD = 0.3


@dataclass
class Model:
    """Two dictionaries (empty bytes: none could be trained) and the calibration's weights."""

    good: bytes
    bad: bytes
    weights: np.ndarray

    def compressors(self) -> list:
        out = []
        for raw in (self.good, self.bad):
            if raw:
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                out.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL))
            else:
                out.append(zstandard.ZstdCompressor(level=LEVEL))
        return out


def _pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)] or [b""]


def features(text: str, compressors: list) -> tuple[float, float, float]:
    """The sizes' difference by the text's size and by the sizes' sum, and the size with the better dictionary."""
    good = bad = size = 0
    for p in _pieces(text):
        good += len(compressors[0].compress(p))
        bad += len(compressors[1].compress(p))
        size += len(p) + 16
    return (bad - good) / size, (bad - good) / (bad + good), min(good, bad) / size


def _dictionary(texts: list[str]) -> bytes:
    pieces = [p for t in texts for p in _pieces(t) if len(p) >= 8]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(256, sum(map(len, pieces)) // 4)), pieces).as_bytes()
    except zstandard.ZstdError:  # too little text
        return b""


def fit(sample: list[tuple[str, int]], prior: float | None = None) -> Model:
    """Dictionaries from two thirds of the sample, calibration on the rest, moved from the sample's share of label 1 to `prior`. Of one class alone, or nothing: its share, for any text."""
    ys = np.array([y for _, y in sample], dtype=float)
    if len(set(ys.tolist())) < 2:
        p = 0.5 if not len(ys) else float(np.clip(ys[0], 0.05, 0.95))
        return Model(b"", b"", np.array([0, 0, 0, np.log(p / (1 - p))]))
    train = [s for i, s in enumerate(sample) if i % 3]
    held = [s for i, s in enumerate(sample) if i % 3 == 0]
    model = Model(_dictionary([t for t, y in train if y == 1]), _dictionary([t for t, y in train if y == 0]), np.zeros(4))
    c = model.compressors()
    x = np.array([features(t, c) for t, _ in held])
    y = np.array([y for _, y in held], dtype=float)
    if len(set(y.tolist())) == 2:
        model.weights = logistic(x * 10, y) * np.array([10, 10, 10, 1])
        if prior is not None:
            prior, share = np.clip((prior, y.mean()), 0.005, 0.995)
            model.weights[3] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with `score` (0 to 1); a null text is scored as an empty one. Any other column stays; `score` is replaced."""
    rest = [c for c in docs.columns if c not in (text, "score")]
    own = docs.select(F.col(text).cast("string").alias("t"), F.struct(F.lit(0).alias("__none"), *rest).alias("rest"))

    def run(batches):
        c = model.compressors()
        for b in batches:
            x = np.array([features(t or "", c) for t in b.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(x @ model.weights[:3] + model.weights[3])), b.column(1)], names=["t", "score", "rest"])

    out = own.mapInArrow(run, f"t string, score double, rest {own.schema['rest'].dataType.simpleString()}")
    return out.select(*[F.col("t").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns if c != "score"], "score")


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most sample_rows labelled documents of each class whose crc32(doc_id) mod 5 is not 0, calibrated at the share of label 1 among all of these."""
    return fit(*labelled_sample(docs, labels, "quality", crc_mod(F.col("doc_id"), 5) != 0, sample_rows, text, doc_id))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, learn(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
