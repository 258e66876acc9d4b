"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed table of (h1, h2, n_docs, last_doc), sorted by hash: 128
hash bits of a line, in how many documents of its batch it was found, and the
largest of their ids. Each batch of documents meets the runs in merge
anti-joins: lines that no run holds become the batch's own run at level 0, the
others are noted as increments. FANOUT runs of a level are merged into one of
the next, so a line is rewritten once a level. Runs and increments give in how
many documents a line is, and which document keeps it.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, materialize, new_path, read, remove, shuffles

MIN_CHARS, MIN_DOCS, FANOUT = 40, 5, 2
#: In how many batches a corpus comes that is all there from the start. A batch is as distributed as the whole: more of them cost runs, and save no memory.
BATCHES = 2
#: Line occurrences for each bucket of a run, up to as many buckets as shuffle partitions: small runs are few files.
BUCKET_LINES = 250_000
_STRIP = " \t\n\x0b\x0c\r"
_LOWER = {i: i + 32 for i in range(65, 91)}
#: Stands for a null id: below every id, so never the one that keeps a line unless all ids are null.
NO_ID = -(1 << 63)


def line_key(line: str) -> str:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(_STRIP).translate(_LOWER)


def _digest(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))


def _halves(digests: list[bytes]) -> list[pa.Array]:
    import numpy as np

    both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return [pa.array(both[:, 0]), pa.array(both[:, 1])]


class LineRuns:
    """The levelled runs of one corpus: bucketed, sorted tables in the shared folder, so that joins between them merge without a shuffle."""

    KEYS = ("h1", "h2")

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []
        self.increments: list[str] = []
        self._paths: dict[str, str] = {}

    def _write(self, lines: DataFrame) -> str:
        path = new_path(self.spark, "line-run")
        name = f"line_run_{path.rsplit('-', 1)[1]}"
        rows = lines.repartition(self.buckets, *self.KEYS)
        rows.write.bucketBy(self.buckets, *self.KEYS).sortBy(*self.KEYS).option("path", path).format("parquet").saveAsTable(name)
        self._paths[name] = path
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            remove(self.spark, self._paths.pop(name))

    def _read(self, *names: str) -> DataFrame:
        return reduce(DataFrame.unionByName, map(self.spark.table, names))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    @classmethod
    def _sum(cls, lines: DataFrame) -> DataFrame:
        return lines.groupBy(*cls.KEYS).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of batch (h1, h2, ...) whose line no run holds: one merge anti-join a run."""
        for name in self.runs():
            batch = batch.join(self.spark.table(name).select(*self.KEYS).hint("merge"), list(self.KEYS), "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """batch: (doc, h1, h2), each line once for a document.

        Lines that no run holds become the batch's own run; of the others the
        documents are noted as increments. So every line is in one run.
        """
        own = self._write(self._sum(batch.select(*self.KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("doc").alias("last_doc"))))
        if not self.runs():
            self._put(0, own)
            return
        rows = self.spark.table(own)
        fresh = self._write(self.unseen(rows))
        self.increments.append(self._write(rows.join(self.spark.table(fresh).select(*self.KEYS).hint("merge"), list(self.KEYS), "left_anti")))
        self._drop(own)
        self._put(0, fresh)

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._write(self._read(*old))
            self._drop(*old)
            self._put(level + 1, merged)

    def totals(self) -> DataFrame | None:
        """(h1, h2, n_docs, last_doc) of every line; None before the first batch."""
        if not self.runs():
            return None
        known = self._read(*self.runs())
        if not self.increments:
            return known
        more = self._sum(self._read(*self.increments)).select(*self.KEYS, F.col("n_docs").alias("more"), F.col("last_doc").alias("later"))
        both = known.join(more.hint("merge"), list(self.KEYS), "left")
        return both.select(*self.KEYS, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc"))

    def close(self) -> None:
        self._drop(*self.runs(), *self.increments)
        self.levels, self.increments = [], []


def stage_lines(docs: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(doc, h1, h2) for each document and different line key of min_chars code points or more."""

    def run(batches):
        for b in batches:
            ids, digests = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys = {k for line in (t or "").split("\n") if len(line) >= min_chars and len(k := line_key(line)) >= min_chars}
                digests += map(_digest, keys)
                ids += [i] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *_halves(digests)], names=["doc", "h1", "h2"])

    own = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text).cast("string").alias("t"))
    return own.mapInArrow(run, "doc long, h1 long, h2 long")


def drops(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc, lines): the digests of the lines that a document loses; documents that lose none are absent.

    Lines in more documents than a task's mean share of all occurrences are at
    most as many as tasks, so these few are broadcast and never shuffled; all
    others meet their documents by key.
    """
    spark = docs.sparkSession
    n = shuffles(docs)
    staged = new_path(spark, "lines")
    lines = stage_lines(docs, text, doc_id, min_chars)
    lines.withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(staged)
    every = spark.read.schema("doc long, h1 long, h2 long, batch int").parquet(staged)
    occurrences = every.count()
    runs = LineRuns(spark, max(1, min(n, occurrences // BUCKET_LINES)))
    for k in range(batches):
        runs.add(every.where(F.col("batch") == k).select("doc", "h1", "h2"))
    common = materialize(runs.totals().where(F.col("n_docs") >= min_docs), "lines-common")
    keys = ["h1", "h2"]
    met = join_hot(every, common, keys, "n_docs", occurrences / n)
    lost = met.where("doc < last_doc").select("doc", *keys).distinct()
    # a document's own lines are gathered, never a line's documents
    out = materialize(lost.groupBy("doc").agg(F.collect_list(F.struct(*keys)).alias("lines")), "lines-lost")
    runs.close()
    remove(spark, staged)
    return out


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, kept (text), n_lines (before), n_dropped and the other columns of docs, one row per row.

    A null or empty text is one empty line and stays empty. A line shorter than
    min_chars always stays. Rows with one id count as so many documents, and
    keep or lose a line together. A null id is below every other. Columns of docs named
    kept, n_lines or n_dropped are replaced. An empty table gives an empty result.
    """
    docs = docs.drop(*(c for c in ("kept", "n_lines", "n_dropped") if c not in (text, doc_id)))
    lost = drops(docs.select(text, doc_id), text, doc_id, min_chars, min_docs, batches)
    rest = [f.name for f in docs.schema if f.name not in (text, doc_id)]
    packed = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("__doc"), F.col(text).cast("string").alias("__text"), F.struct(F.lit(0).alias("__none"), *rest).alias("__rest"))
    # one plan at every size: the lines that documents lose grow with the corpus
    joined = packed.join(lost.hint("merge"), packed["__doc"] == lost["doc"], "left").select("__id", "__text", "lines", "__rest")

    def run(batches):
        for b in batches:
            kept, n, gone = [], [], []
            for t, drop in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                n.append(len(lines))
                if drop:
                    drop = {x["h1"].to_bytes(8, "little", signed=True) + x["h2"].to_bytes(8, "little", signed=True) for x in drop}
                    lines = [x for x in lines if len(x) < min_chars or len(k := line_key(x)) < min_chars or _digest(k) not in drop]
                    t = "\n".join(lines)
                kept.append(t or "")
                gone.append(n[-1] - len(lines) if lines else n[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), b.column(3)], names=["id", "kept", "n_lines", "n_dropped", "rest"])

    kinds = {f.name: f.dataType for f in joined.schema}
    out = joined.mapInArrow(run, f"id {kinds['__id'].simpleString()}, kept string, n_lines long, n_dropped long, rest {kinds['__rest'].simpleString()}")
    return out.select(F.col("id").alias(doc_id), "kept", "n_lines", "n_dropped", *[F.col("rest").getField(c).alias(c) for c in rest])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, i, ls[i] AS line,
        translate(regexp_replace(regexp_replace(ls[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM d, unnest(generate_series(1, len(ls))) AS u(i)),
c AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT rid) >= 5),
m AS (SELECT l.*, c.last IS NOT NULL AND l.doc_id < c.last AS gone FROM l LEFT JOIN c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
