"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length into buckets and written, each bucket a packed
matrix, longest vector first. For a query with a running k-th best score theta,
a bucket's local cosine threshold is theta over the product of the query's and
the bucket's greatest length. Above 1 the bucket is passed over. A high
threshold prunes by coordinates: a vector that reaches it lies, in the query's
largest coordinate, within a cap around the query. A low one prunes by length,
taking the bucket's vectors down to theta over the query's length. What is left
is multiplied out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read, shuffles

K, QUERY_BLOCK = 5, 2048
#: Bytes of a bucket's matrix, so that an Arrow batch of buckets stays small; buckets of the longest vectors that give first bounds.
BUCKET_BYTES, SEED_BUCKETS = 1 << 16, 8
#: Packed pieces that make up a block of queries, at most 1 << BLOCK_BITS.
BLOCK_BITS = 3
SLACK = 1 + 1e-9
PIECE = ("n", "ids", "norms", "v", "width")
PACKED = "bucket long, n int, top double, ids binary, norms binary, v binary, width int"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
#: From this local cosine threshold on, coordinates prune better than lengths.
COORDINATE_FROM = 0.75


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (floor(256 x) of each component), norm; without null ids, null vectors and those with a null or non-finite component."""
    e = F.col(embedding)
    fine = e.isNotNull() & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    v = F.transform(e, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    out = vectors.where(fine & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return out.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles, which multiply faster, while every sum stays below 2**53."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return q @ v.T


class Best:
    """The k best (score, vec_id) of each query, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max)

    def theta(self) -> np.ndarray:
        """What a candidate must reach: a tie may still win by its id."""
        return np.maximum(self.score[:, -1].astype(np.float64), self.floor)

    def offer(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores[i, j]: of query q[i] and candidate ids[j]."""
        s = np.where(self.ids[q][:, None] == ids[None, :], np.iinfo(np.int64).min, scores)
        if s.shape[1] > 4 * self.k:
            # the k largest, and all that tie with the k-th
            cut = np.partition(s, -self.k, axis=1)[:, -self.k]
            some = np.flatnonzero((s >= np.maximum(cut, self.score[q, -1])[:, None]).any(axis=0))
            s, ids = s[:, some], ids[some]
        if not s.shape[1]:
            return
        all_s = np.concatenate((self.score[q], s), axis=1)
        all_i = np.concatenate((self.id[q], np.broadcast_to(ids, s.shape)), axis=1)
        order = np.lexsort((all_i, -all_s.astype(np.float64), ), axis=1)[:, : self.k] if np.abs(all_s[all_s > np.iinfo(np.int64).min]).max(initial=0) < 2**53 else np.array([sorted(range(all_s.shape[1]), key=lambda j: (-int(a[j]), int(b[j])))[: self.k] for a, b in zip(all_s, all_i, strict=True)])
        self.score[q], self.id[q] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)


def search_bucket(best: Best, queries: np.ndarray, q_norm: np.ndarray, v: np.ndarray, ids: np.ndarray, norms: np.ndarray) -> None:
    """Offer one bucket (norms descending) to every query that it can still serve."""
    theta = best.theta()
    reach = q_norm * norms[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(reach > 0, theta / reach, np.where(theta > 0, np.inf, -np.inf))
    local = np.where(np.isneginf(theta), -np.inf, local)
    live = local <= SLACK
    by_coordinate = live & (local >= COORDINATE_FROM)
    by_length = np.flatnonzero(live & ~by_coordinate)
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(theta[by_length] > 0, theta[by_length] / np.maximum(q_norm[by_length], 1e-300), 0) / SLACK
        n = int(np.searchsorted(-norms, -least.min(), side="right"))
        if n:
            best.offer(by_length, _products(queries[by_length], v[:n]), ids[:n])
    if by_coordinate.any():
        unit = v / np.maximum(norms, 1e-300)[:, None]
        for i in np.flatnonzero(by_coordinate):
            u = queries[i] / q_norm[i]
            f = int(np.argmax(np.abs(u)))
            c, t = u[f], min(1.0, local[i] / SLACK)
            spread = np.sqrt(max(0.0, 1 - c * c)) * np.sqrt(max(0.0, 1 - t * t))
            some = np.flatnonzero((unit[:, f] >= c * t - spread - 1e-9) & (unit[:, f] <= c * t + spread + 1e-9) if not _covers(c, t) else _side(unit[:, f], c, t, spread))
            if len(some):
                best.offer(np.array([i]), _products(queries[i : i + 1], v[some]), ids[some])


def _covers(c: float, t: float) -> bool:
    """Whether the cap of cosine t around the query holds the axis' pole, so that one side is open."""
    return abs(c) >= t


def _side(x: np.ndarray, c: float, t: float, spread: float) -> np.ndarray:
    return x >= c * t - spread - 1e-9 if c > 0 else x <= c * t + spread + 1e-9


def _buckets(rows: DataFrame, most_bytes: int = BUCKET_BYTES) -> DataFrame:
    """rows of quantized(), packed in the order they come in: bucket (its partition and number), n, top (greatest length), ids, norms and v as binary.

    A bucket holds its vectors longest first, in one matrix of 32-bit integers
    (64 where a component needs them), shorter vectors filled up with zeros.
    """

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, norms, v = b.column(0).to_numpy(), b.column(2).to_numpy(), b.column(1)
            sizes, flat = v.value_lengths().to_numpy(), v.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(sizes)))
            step = max(16, most_bytes // (4 * max(1, int(sizes.max(initial=0)))))
            out = []
            for at in range(0, len(ids), step):
                end = min(len(ids), at + step)
                dim = int(sizes[at:end].max(initial=0))
                m = np.zeros((end - at, dim), dtype=np.int64)
                m[np.arange(dim) < sizes[at:end, None]] = flat[ends[at] : ends[end]]
                order = np.argsort(-norms[at:end], kind="stable")
                m = m[order]
                if np.abs(m).max(initial=0) < 2**31:
                    m = m.astype(np.int32)
                out.append(((part << 32) | seq, end - at, float(norms[at:end].max()), ids[at:end][order].tobytes(), norms[at:end][order].tobytes(), m.tobytes(), m.itemsize))
                seq += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)], names=_NAMES)

    return rows.select("vec_id", "v", "norm").mapInArrow(run, PACKED)


def _unpack(n: int, ids: bytes, norms: bytes, v: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(norms), np.frombuffer(v, dtype=f"i{width}").reshape(n, -1).astype(np.int64)


def _wide(m: np.ndarray, dim: int) -> np.ndarray:
    return m if m.shape[1] >= dim else np.pad(m, ((0, 0), (0, dim - m.shape[1])))


def _stack(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed rows as one: ids, norms, matrix."""
    ids, norms, v = zip(*(_unpack(*p) for p in parts), strict=True)
    dim = max(m.shape[1] for m in v)
    return np.concatenate(ids), np.concatenate(norms), np.concatenate([_wide(m, dim) for m in v])


def _with_floors(queries: DataFrame, seed: list[tuple], k: int) -> DataFrame:
    """Packed queries with floors (binary): a lower bound of each query's k-th best, taken from the longest vectors; and least, the length that a bucket must reach to serve any of them."""

    def run(batches):
        for b in batches:
            floors, least = [], []
            for row in zip(*(b.column(c).to_pylist() for c in ("n", "ids", "norms", "v", "width")), strict=True):
                ids, norms, q = _unpack(*row)
                best = Best(ids, k, np.full(len(ids), -np.inf))
                for s in seed:
                    s_ids, _, s_v = _unpack(*s)
                    dim = max(q.shape[1], s_v.shape[1])
                    best.offer(np.arange(len(ids)), _products(_wide(q, dim), _wide(s_v, dim)), s_ids)
                floor = np.where(best.score[:, -1] == np.iinfo(np.int64).min, -np.inf, best.score[:, -1].astype(np.float64))
                need = np.where((floor > 0) & (norms > 0), floor / np.maximum(norms, 1e-300), -1.0)
                floors.append(floor.tobytes())
                least.append(float(need.min()) / SLACK if need.min() > 0 else -1.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(floors, pa.binary()), pa.array(least, pa.float64())], names=[*_NAMES, "floors", "least"])

    return queries.mapInArrow(run, f"{PACKED}, floors binary, least double")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k greatest inner products over vectors, without the query's own id.

    Vectors null, with a null or non-finite component or with a null id take no
    part, on either side; shorter vectors count as filled up with zeros. Ties go to the smaller
    vec_id. Repeated ids are so many candidates. Fewer than k candidates: all.
    An empty table gives an empty result. Columns of either table besides the
    two play no part.

    One job pairs blocks of about query_block queries with the buckets that are
    long enough to serve them. Pairs are dealt out by block and lane; a task
    holds one block and sees its lane's buckets longest first, so its running
    k-th best prunes the later ones. All joins are on keys; nothing but the
    longest vectors' buckets (SEED_BUCKETS of them) is sent to every task.
    """
    spark = vectors.sparkSession
    n = shuffles(vectors)
    # equal lengths are dealt out by a hash of the id: no length can fill a partition alone
    ordered = quantized(vectors, vec_id, embedding).repartitionByRange(n, F.desc("norm"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id")
    buckets = materialize(_buckets(ordered), "topk-buckets")
    asked = quantized(queries, vec_id, embedding)
    seed = [tuple(r) for r in buckets.orderBy(F.desc("top"), "bucket").select("n", "ids", "norms", "v", "width").limit(SEED_BUCKETS).collect()]
    parts = max(1, -(-queries.count() // query_block))
    packed = materialize(_with_floors(_buckets(asked.repartition(parts)), seed, k), "topk-queries")
    lanes = max(1, -(-n // parts))

    # a block is a few pieces that one partition packed; they travel together
    asks = packed.withColumn("block", F.shiftright("bucket", BLOCK_BITS)).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    stats = asks.groupBy("block", "lane").agg(F.min("least").alias("least"))
    dealt = buckets.select("bucket", "top", F.pmod(F.xxhash64("bucket"), F.lit(lanes)).cast("int").alias("lane"))
    pairs = dealt.join(stats.hint("merge"), "lane").where("top >= least").select("bucket", "lane", "block")
    served = buckets.join(pairs.hint("merge"), "bucket").select("block", "lane", F.lit(1).alias("kind"), "top", "bucket", *PIECE, F.lit(None).cast("binary").alias("floors"))
    own = asks.select("block", "lane", F.lit(0).alias("kind"), F.lit(0.0).alias("top"), "bucket", *PIECE, "floors")
    rows = own.unionByName(served).repartition(n, "block", "lane").sortWithinPartitions("block", "lane", "kind", F.desc("top"), "bucket")

    def run(batches):
        key, held, floors, best, q, q_norm = None, [], [], None, None, None

        def found():
            at, j = np.nonzero(best.score != np.iinfo(np.int64).min)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), key[0])), pa.array(at), pa.array(best.ids[at]), pa.array(best.id[at, j]), pa.array(best.score[at, j])], names=["block", "q", "query_id", "vec_id", "score"])

        for b in batches:
            for block, lane, kind, n_, ids, norms, v, width, floor in zip(*(b.column(c).to_pylist() for c in ("block", "lane", "kind", *PIECE, "floors")), strict=True):
                if (block, lane) != key:
                    if best is not None:
                        yield found()
                    key, held, floors, best = (block, lane), [], [], None
                if kind == 0:
                    held.append((n_, ids, norms, v, width))
                    floors.append(np.frombuffer(floor))
                    continue
                if best is None:
                    q_ids, q_norm, q = _stack(held)
                    best = Best(q_ids, k, np.concatenate(floors))
                c_ids, c_norms, c = _unpack(n_, ids, norms, v, width)
                q = _wide(q, c.shape[1])
                search_bucket(best, q, q_norm, _wide(c, q.shape[1]), c_ids, c_norms)
        if best is not None:
            yield found()

    near = rows.mapInArrow(run, "block long, q long, query_id long, vec_id long, score long")
    # at most k rows a lane of each query
    ranked = near.groupBy("block", "q", "query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))), 1, k).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(own, own.where(F.col("vec_id") % 50 == 0))


OP10_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
