"""Mixing sources to target weights.

Each source's documents are laid end to end in a pseudorandom order and their
words packed into blocks of BLOCK words. The mix is a row of slots, one block
each, cut into output shards. Each shard draws its source counts multinomially,
by the sources' shares, from a generator of its own, so shards are drawn side
by side on the executors. Counts run up over the shards: what a source draws
beyond its slots is cut, what is left undrawn goes to shards at the end, so the
totals are met exactly. A source's slots, counted over all shards, walk through
its blocks in passes; in each pass a keyed pseudorandom permutation maps the
slot to a block, and slots meet blocks in an equi-join by index.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, read, shuffles

BLOCK, SHARD_SLOTS, SEED, MOST_REPEATS = 64, 1 << 16, 20240229, 3
#: Documents of a source are put in order in so many pieces at least, of about so many documents.
PIECES, PIECE_DOCS = 256, 1 << 16
#: Sources up to which the plan, a row for each, is broadcast; beyond, it is dealt out under SALTS.
BROADCAST_SOURCES, SALTS = 1 << 16, 64
_PARTS = ("pass", "from_word", "n_words")


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST_REPEATS) -> list[float]:
    """Share total by weight; a target stops at `most` times its size and the excess is reshared until none is above."""
    out = [0.0] * len(sizes)
    open_ = [i for i in range(len(sizes)) if sizes[i] > 0]
    left = float(total)
    while open_:
        each = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * each > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = weights[i] * each
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in over]
    return out


def source_plan(sizes: DataFrame, block: int = BLOCK, most: int = MOST_REPEATS) -> pd.DataFrame:
    """One row per source, in order of code points, null last: k, source, source_size, target, blocks, slots, pieces.

    Collected: one row per source, not per document.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    n = [int(r["n"]) for r in rows]
    want = targets(n, [1 + i % 3 for i in range(len(n))], sum(n), most)
    out = []
    for k, (r, size, t) in enumerate(zip(rows, n, want, strict=True)):
        blocks = -(-size // block)
        # whole passes, then blocks of one more pass up to the target
        whole = int(t // size) if size else 0
        slots = whole * blocks + min(blocks, round((t - whole * size) / block)) if whole < most else most * blocks
        out.append((k, r["source"], size, t, blocks, slots, max(PIECES, -(-r["docs"] // PIECE_DOCS))))
    return pd.DataFrame(out, columns=["k", "source", "source_size", "target", "blocks", "slots", "pieces"])


def _before(rows: DataFrame, piece: Column, order: list, value: str) -> DataFrame:
    """rows with `before`: the sum of `value` over the rows of the same k that come first, by piece, then order.

    Pieces are summed with map-side combining; only a piece's rows, and the
    pieces of one k, are ever put in order together.
    """
    rows = rows.withColumn("piece", piece)
    sums = rows.groupBy("k", "piece").agg(F.sum(value).alias("n_piece"))
    sums = sums.select("k", "piece", (F.sum("n_piece").over(Window.partitionBy("k").orderBy("piece")) - F.col("n_piece")).alias("base"))
    inside = F.sum(value).over(Window.partitionBy("k", "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    return rows.withColumn("inside", inside).join(sums, ["k", "piece"]).withColumn("before", F.col("base") + F.col("inside")).drop("piece", "inside", "base")


def shard_draws(spark: SparkSession, plan: pd.DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, k, start, n, blocks): how many slots of each shard go to source k, from which of the source's slots on."""
    kind = "shard long, k int, start long, n long, blocks long"
    slots = plan["slots"].to_numpy(dtype=np.int64)
    total = int(slots.sum())
    if not total:
        return spark.createDataFrame([], kind)
    shards, share = -(-total // shard_slots), slots / total

    def draw(batches):
        for pdf in batches:
            for shard in pdf["id"].tolist():
                n = np.random.default_rng((seed, shard)).multinomial(min(shard_slots, total - shard * shard_slots), share)
                k = np.flatnonzero(n)
                yield pd.DataFrame({"shard": shard, "k": k, "drawn": n[k]})

    drawn = spark.range(shards).mapInPandas(draw, "shard long, k int, drawn long")
    ran = _before(drawn, F.shiftright("shard", 10), ["shard"], "drawn")
    owed = _plan_rows(spark, plan, "k", "slots", "blocks")
    own = ran.join(owed, "k").select("shard", "k", F.col("before").alias("start"), F.least("drawn", F.col("slots") - F.col("before")).alias("n"), "blocks").where("n > 0")
    met = own.groupBy("k").agg(F.sum("n").alias("met"))
    # what is left of each source follows in shards of its own, as many slots a shard at most
    rest = owed.join(met, "k", "left").select("k", F.coalesce("met", F.lit(0)).alias("met"), "slots", "blocks").where("met < slots")
    rest = rest.withColumn("i", F.explode(F.expr(f"sequence(0L, CAST((slots - met - 1) DIV {shard_slots} AS BIGINT))")))
    start = F.col("met") + F.col("i") * shard_slots
    return own.unionByName(rest.select((F.lit(shards) + F.col("i")).alias("shard"), "k", start.alias("start"), F.least(F.lit(shard_slots), F.col("slots") - start).alias("n"), "blocks"))


def _plan_rows(spark: SparkSession, plan: pd.DataFrame, *columns: str) -> DataFrame:
    """The plan's columns as a table: as many rows as the driver holds already."""
    kinds = {"k": "int", "source": "string", "target": "double"}
    rows = list(zip(*(plan[c].tolist() for c in columns), strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in columns))


def _of_source(rows: DataFrame, plan: pd.DataFrame, *columns: str) -> DataFrame:
    """rows with the plan's columns of their source: broadcast up to BROADCAST_SOURCES, else met under salts, so that no source is one key."""
    known = _plan_rows(rows.sparkSession, plan, "source", *columns)
    same = rows["source"].eqNullSafe(known["source"])
    if len(plan) <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(known), same).drop(known["source"])
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("own_salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    return rows.join(known, rows["source"].eqNullSafe(known["source"]) & (F.col("own_salt") == F.col("salt"))).drop(known["source"]).drop("own_salt", "salt")


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(n) at i: four Feistel rounds over the next even power of two, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(float))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, n, key = i.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for r in range(4):
            f = (right + k + np.uint64(r * 0x9E3779B9)) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def drawn_blocks(spark: SparkSession, plan: pd.DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, k, pass, block) of every slot of the mix."""
    draws = shard_draws(spark, plan, shard_slots, seed)

    def run(batches):
        with np.errstate(over="ignore"):
            for pdf in batches:
                for r in pdf.itertuples(index=False):
                    for at in range(0, r.n, 1 << 16):
                        j = np.arange(r.start + at, r.start + min(r.n, at + (1 << 16)))
                        turn = j // r.blocks
                        key = np.uint64(seed) + (turn * 1_000_003 + r.k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                        yield pd.DataFrame({"shard": r.shard, "k": r.k, "pass": turn, "block": permuted(j % r.blocks, np.full(len(j), r.blocks), key)})

    return draws.repartition(shuffles(draws), "shard", "k").mapInPandas(run, "shard long, k int, pass long, block long")


def placed(sizes: DataFrame, plan: pd.DataFrame) -> DataFrame:
    """Documents with words of sizes (rid, doc_id, th, source, size), with k and `off`, the word of its source at which a document begins."""
    own = _of_source(sizes.where("size > 0").select("rid", "doc_id", "th", "source", "size"), plan, "k", "pieces")
    own = own.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id", "th"))
    return _before(own, F.pmod("h", "pieces"), ["h", "doc_id", "size", "rid"], "size").select("rid", "doc_id", "k", "size", F.col("before").alias("off"))


def taken_pieces(sizes: DataFrame, plan: pd.DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(rid, doc_id, k, pass, from_word, n_words): the pieces of documents that the mix takes; from_word counts within the document."""
    spark = sizes.sparkSession
    docs = placed(sizes, plan)
    first, last = F.floor(F.col("off") / block), F.floor((F.col("off") + F.col("size") - 1) / block)
    parts = docs.withColumn("block", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    start = F.greatest(F.col("block") * block, F.col("off"))
    end = F.least((F.col("block") + 1) * block, F.col("off") + F.col("size"))
    parts = parts.select("rid", "doc_id", "k", "block", (start - F.col("off")).alias("from_word"), (end - start).alias("n_words"))
    # the slots' number follows the corpus, which the planner cannot tell: never broadcast them
    return parts.join(drawn_blocks(spark, plan, seed=seed).hint("merge"), ["k", "block"]).select("rid", "doc_id", "k", "pass", "from_word", "n_words")


def document_sizes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, source, size (words), th (a hash of the text) and rid, which tells repeated rows apart, in the shared folder: rid must not change when a task runs again."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return materialize(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"), F.xxhash64(F.col(text)).alias("th")), "mixing-sizes")


def mix_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted), one row per row of docs.

    A null or empty text has size 0 and is never taken; a source without words
    has target 0. A null source is a source of its own, the last. Repeated rows
    are so many documents. No words at all, or an empty table: nothing is taken.
    A run is fixed by the seed, the ids and the texts.
    """
    sizes = document_sizes(docs, text, doc_id, source)
    plan = source_plan(sizes, block)
    taken = taken_pieces(sizes, plan, block, seed).groupBy("rid").agg(F.sum("n_words").alias("taken"))
    out = _of_source(sizes.select("rid", "doc_id", "source", "size"), plan, "source_size", "target").join(taken, "rid", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", n_chars: str = "n_chars", block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mixed corpus, with the columns of docs: a row for each document and pass that takes words of it.

    A pass that takes a document's blocks without a gap gives its text verbatim
    between the first and last word; parts that a gap divides are joined by a
    newline. Rows of one document share its doc_id; rows that repeat both id and
    text are one document, each taken alike. Documents without words go.
    """
    import re

    import pyarrow as pa

    sizes = document_sizes(docs, text, doc_id, source)
    sizes = sizes.groupBy("doc_id", "th", "size").agg(F.min("rid").alias("rid"), F.min(F.struct(F.col("source").isNull(), "source"))["source"].alias("source"))
    sizes = materialize(sizes.select("rid", "doc_id", "th", "source", "size"), "mixing-documents")
    plan = source_plan(sizes, block)
    # a document's pieces in order of pass and place, as three arrays of numbers
    taken = taken_pieces(sizes, plan, block, seed).groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pass", "from_word", "n_words"))).alias("parts"))
    taken = sizes.select("rid", F.col("doc_id").alias("__doc"), "th").join(taken, "rid").select("__doc", "th", *[F.col(f"parts.{c}").alias(f"__{c}") for c in _PARTS])
    names = docs.columns
    own = docs.withColumn("__th", F.xxhash64(F.col(text)))
    rest = F.struct(*[c for c in names if c not in (text, n_chars)]).alias("rest")
    joined = own.join(taken, own[doc_id].eqNullSafe(taken["__doc"]) & (own["__th"] == taken["th"])).select(F.col(text).cast("string").alias("t"), *[F.col(f"__{c}") for c in _PARTS], rest)
    word = re.compile(WORD)

    def run(batches):
        for b in batches:
            at, texts, sizes = [], [], []
            parts = [b.column(k) for k in (1, 2, 3)]
            ends = np.concatenate(([0], np.cumsum(parts[0].value_lengths().to_numpy())))
            turn, first, n = (p.flatten().to_numpy() for p in parts)
            for i, t in enumerate(b.column(0).to_pylist()):
                spans = np.array([m.span() for m in word.finditer(t)], dtype=np.int64)
                own = slice(ends[i], ends[i + 1])
                turns, starts, stops = turn[own], first[own], first[own] + n[own]
                # a run ends where the pass ends, or where the next piece does not follow on
                new = np.append(True, (turns[1:] != turns[:-1]) | (starts[1:] != stops[:-1]))
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(turns)) - 1
                said: dict[int, list[str]] = {}
                for a, e in zip(heads.tolist(), tails.tolist(), strict=True):
                    said.setdefault(int(turns[a]), []).append(t[spans[starts[a], 0] : spans[stops[e] - 1, 1]])
                for pieces in said.values():
                    at.append(i)
                    texts.append("\n".join(pieces))
                    sizes.append(len(texts[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), b.column(4).take(pa.array(at, pa.int64()))], names=["t", "n", "rest"])

    rest = joined.schema["rest"].dataType.simpleString()
    out = joined.mapInArrow(run, f"t string, n long, rest {rest}")
    return out.select(*[F.col("t").alias(c) if c == text else F.col("n").alias(c) if c == n_chars else F.col("rest").getField(c).alias(c) for c in names])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
