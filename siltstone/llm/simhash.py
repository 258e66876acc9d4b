"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint is a leaf of a binary trie. Two nodes of equal depth are visited
together with the number of bits in which their prefixes differ; their children
pair up four ways, and a pair whose differing bits exceed the budget ends there
with everything below it.

Two fingerprints within 3 bits agree on one of their four 16-bit blocks, so with
each block in turn rotated to the top the only pairs of nodes at depth 16 that
can lead to a new link are a node with itself. From there the traversal is dealt
out: pairs of nodes with more than UNIT leaves are opened STRIDE levels at a
time by joins of node tables, under the same budget, until each that is left is
work for one task, which goes on below it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read, shuffles
from .components import components

BITS, BUDGET, SHINGLE, SEED = 64, 3, 3, 42
#: Leaves of a node that one task goes through, as a pair the geometric mean of both; levels that a larger one is opened at once.
UNIT, STRIDE = 100_000, 4
#: Node pairs that one step of the traversal holds at most.
FRONTIER = 1 << 19


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the words' 3-shingles, repeats counted; 0 if there is no word."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b"%b %b %b" % s, SEED) for s in zip(words, words[1:], words[2:], strict=False)]
    n = len(hashes)
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 4096):
        ones += np.unpackbits(raw[i : i + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) and th (a hash of the text) of every row."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t) for t in b.column(1).to_pylist()), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)], names=["doc_id", "fp", "th"])

    t = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("t"), F.xxhash64(t).alias("th")).mapInArrow(run, "doc_id long, fp long, th long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class _Labels:
    """Components among sorted leaves, kept as the smallest index of each."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        of = self.of
        while len(a):
            x, y = of[a], of[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            rest = low < high
            if not rest.any():
                return
            a, b, low, high = a[rest], b[rest], low[rest], high[rest]
            np.minimum.at(of, high, low)
            while True:  # each label points to its root again
                up = of[of]
                if (up == of).all():
                    break
                of = up
            self.of = of

    def run_ends(self) -> np.ndarray:
        """For each leaf, the index behind the run of leaves of its component."""
        of = self.of
        cut = np.flatnonzero(of[1:] != of[:-1]) + 1
        ends = np.append(cut, len(of))
        return np.repeat(ends, np.diff(np.concatenate(([0], ends))))


def trie_links(a: np.ndarray, roots: list[tuple[int, int, int, int]], depth: int, budget: int, labels: _Labels) -> None:
    """Link the leaves of `a` (sorted, distinct) that lie under the node pairs `roots` within `budget` bits.

    A root is (low, high, low2, high2): the ranges of leaves below its nodes at
    `depth`. Pairs whose leaves are all in one component already add nothing
    and end, so a dense cloud of fingerprints costs about its nodes, not its
    pairs. The stack goes depth first in blocks, which bounds its memory.
    """
    r = np.array(roots, dtype=np.int64).reshape(-1, 4)
    first = np.zeros(len(r), dtype=np.int64)
    for k in range(depth):  # bits in which the prefixes differ
        shift = np.uint64(BITS - 1 - k)
        first += ((a[r[:, 0]] >> shift) & np.uint64(1)) != ((a[r[:, 2]] >> shift) & np.uint64(1))
    stack = [(depth, np.column_stack((r, first)))]
    ends, steps = labels.run_ends(), 0
    while stack:
        d, f = stack.pop()
        if len(f) > FRONTIER:
            stack.append((d, f[FRONTIER:]))
            f = f[:FRONTIER]
        if steps and steps % 8 == 0:
            ends = labels.run_ends()
        steps += 1
        one = labels.of[f[:, 0]] == labels.of[f[:, 2]]
        f = f[~(one & (ends[f[:, 0]] >= f[:, 1]) & (ends[f[:, 2]] >= f[:, 3]))]
        leaf = (f[:, 1] - f[:, 0] == 1) & (f[:, 3] - f[:, 2] == 1)
        if leaf.any():
            x, y = f[leaf, 0], f[leaf, 2]
            near = (x != y) & (_popcount(a[x] ^ a[y]) <= budget)
            labels.link(x[near], y[near])
            f = f[~leaf]
        if not len(f) or d == BITS:
            continue
        shift = np.uint64(BITS - 1 - d)
        both = np.unique(np.concatenate((f[:, :2], f[:, 2:4])), axis=0)
        # where the ones begin: leaves are sorted, so below a node they come last
        bit = np.uint64(1) << shift
        at = a[both[:, 0]] & ~((bit << np.uint64(1)) - np.uint64(1) if d else np.uint64(0xFFFFFFFFFFFFFFFF)) | bit
        cut = np.clip(np.searchsorted(a, at), both[:, 0], both[:, 1])
        key = both[:, 0] * (len(a) + 1) + both[:, 1]

        def split(low: np.ndarray, high: np.ndarray, key=key, cut=cut) -> np.ndarray:
            return cut[np.searchsorted(key, low * (len(a) + 1) + high)]

        m, m2 = split(f[:, 0], f[:, 1]), split(f[:, 2], f[:, 3])
        l, h, l2, h2, e = f.T
        same = (l == l2) & (h == h2)
        kids = [np.column_stack(c) for c in ((l, m, l2, m2, e), (m, h, m2, h2, e))]
        far = e < budget
        kids.append(np.column_stack((l, m, m2, h2, e + 1))[far])
        kids.append(np.column_stack((m, h, l2, m2, e + 1))[far & ~same])
        kids = np.concatenate(kids)
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3])]
        if len(kids):
            # those of few differing bits on top: their links let others end early
            stack.append((d + 1, kids[np.argsort(kids[:, 4], kind="stable")]))


def _rotated(fp: np.ndarray, block: int) -> np.ndarray:
    k = 16 * block
    return fp if not k else (fp << np.uint64(k)) | (fp >> np.uint64(BITS - k))


def _join(groups: list[tuple[int, np.ndarray]]) -> pd.DataFrame:
    """(a, b) with a < b as signed: each linked fingerprint and its group's representative, of nodes of one block."""
    out = []
    for block in range(4):
        mine = [g for k, g in groups if k == block]
        if not mine:
            continue
        fp = np.unique(np.concatenate(mine))
        a = np.sort(_rotated(fp, block))
        top = (a >> np.uint64(48)).astype(np.int64)
        low = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
        high = np.append(low[1:], len(a))
        big = high - low > 1
        labels = _Labels(len(a))
        if big.any():
            trie_links(a, np.column_stack((low, high, low, high))[big], 16, BUDGET, labels)
        i = np.flatnonzero(labels.of != np.arange(len(a)))
        back = _rotated(a, 4 - block) if block else a
        out.append((back[labels.of[i]].view(np.int64), back[i].view(np.int64)))
    a, b = (np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in (0, 1))
    return pd.DataFrame({"a": a, "b": b})


def _rotated_column(block: Column) -> Column:
    """fp with the 16-bit block rotated to the top."""
    out = F.col("fp")
    for k in (1, 2, 3):
        out = F.when(block == k, F.shiftleft("fp", 16 * k).bitwiseOR(F.shiftrightunsigned("fp", BITS - 16 * k))).otherwise(out)
    return out


def _pair_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """(a, b) as _join() gives, of the leaves of one pair of nodes."""
    block, depth, p, q = (int(pdf[c].iloc[0]) for c in ("block", "depth", "p", "q"))
    a = np.sort(_rotated(pdf["fp"].to_numpy().view(np.uint64), block))
    node = (a >> np.uint64(BITS - depth)).view(np.int64)
    labels = _Labels(len(a))
    x = tuple(int(np.searchsorted(node, n, side)) for n in (p, q) for side in ("left", "right"))
    if x[0] < x[1] and x[2] < x[3]:
        trie_links(a, [x], depth, BUDGET, labels)
    i = np.flatnonzero(labels.of != np.arange(len(a)))
    back = _rotated(a, 4 - block) if block else a
    return pd.DataFrame({"a": back[labels.of[i]].view(np.int64), "b": back[i].view(np.int64)})


def _opened(leaves: DataFrame, pairs: DataFrame, unit: int) -> list[DataFrame]:
    """leaves: block, rot, fp. pairs: block, p, q, err: pairs of nodes at depth 16. The leaves of the smaller pairs that they lead to, a table (block, depth, p, q, fp) for each depth."""
    out, depth = [], 16
    pairs = materialize(pairs, "simhash-pairs")
    while depth < BITS and not pairs.isEmpty():
        depth += STRIDE
        node = F.shiftrightunsigned("rot", BITS - depth)
        kids = materialize(leaves.groupBy("block", node.alias("kid")).agg(F.count(F.lit(1)).alias("n")).withColumn("parent", F.shiftrightunsigned("kid", STRIDE)), "simhash-nodes")
        x, y = (kids.select("block", F.col("parent").alias(c), F.col("kid").alias(f"{c}_kid"), F.col("n").alias(f"{c}_n")) for c in ("p", "q"))
        err = F.col("err") + F.bit_count(F.col("p_kid").bitwiseXOR(F.col("q_kid")).bitwiseAND(F.lit((1 << STRIDE) - 1).cast("long")))
        met = pairs.join(x, ["block", "p"]).join(y, ["block", "q"]).where("p <> q OR p_kid < q_kid OR (p_kid = q_kid AND p_n > 1)")
        met = met.select("block", F.col("p_kid").alias("p"), F.col("q_kid").alias("q"), err.alias("err"), (F.col("p_n").cast("double") * F.col("q_n")).alias("work")).where(F.col("err") <= BUDGET)
        met = materialize(met, "simhash-pairs")
        small = (F.col("work") <= float(unit) ** 2) | F.lit(depth >= BITS)
        ready = met.where(small).select("block", F.lit(depth).alias("depth"), "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("node"))
        out.append(leaves.select("block", node.alias("node"), "fp").join(ready, ["block", "node"]).select("block", "depth", "p", "q", "fp"))
        pairs = met.where(~small).drop("work")
    return out


def links(distinct: DataFrame, unit: int | None = None) -> DataFrame:
    """distinct: fp, each once. (a, b): links that join the same fingerprints as all pairs within 3 bits do."""
    unit = unit or UNIT
    n = shuffles(distinct)
    dealt = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("block"))
    dealt = dealt.withColumn("rot", _rotated_column(F.col("block"))).withColumn("node", F.shiftrightunsigned("rot", 48))
    large = materialize(dealt.groupBy("block", "node").count().where(F.col("count") > unit).select("block", "node"), "simhash-large")
    small = dealt.join(large, ["block", "node"], "left_anti").select("fp", "block", F.col("node").cast("int").alias("node"))

    def run(batches):
        # a task's nodes come together; it holds the fingerprints of one slice of nodes at a time
        for pdf in _by_node(batches):
            yield _join([(int(k), g["fp"].to_numpy().view(np.uint64)) for k, g in pdf.groupby("block")])

    near = small.repartition(4 * n, "block", "node").sortWithinPartitions("node", "block").mapInPandas(run, "a long, b long")
    if large.isEmpty():
        return near
    leaves = materialize(dealt.join(large, ["block", "node"], "left_semi").select("block", "rot", "fp"), "simhash-opened")
    for t in _opened(leaves, large.select("block", F.col("node").alias("p"), F.col("node").alias("q"), F.lit(0).alias("err")), unit):
        near = near.unionByName(t.groupBy("block", "depth", "p", "q").applyInPandas(_pair_links, "a long, b long"))
    return near


def _by_node(batches, least: int = 200_000):
    """Batches regrouped so that no node is cut; rows come sorted by node."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows >= least:
            pdf = pd.concat(held)
            last = pdf[["node", "block"]].iloc[-1]
            cut = (pdf["node"] == last["node"]) & (pdf["block"] == last["block"])
            if not cut.all():
                yield pdf[~cut]
                pdf = pdf[cut]
            held, rows = [pdf], len(pdf)
    if held:
        yield pd.concat(held)


def _groups(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """fingerprints(), and fp with the root of its group for each different one."""
    prints = materialize(fingerprints(docs, text, doc_id), "simhash-prints")
    leaves = materialize(prints.select("fp").distinct(), "simhash-leaves")
    roots = components(materialize(links(leaves), "simhash-links"))  # node, root: of linked fingerprints alone
    named = leaves.join(roots, leaves["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, named


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fp and component_id of every row of docs.

    component_id is the smallest doc_id reachable over links of at most 3
    differing bits. Null, empty and blank texts have fingerprint 0 and link like
    any other. Equal fingerprints (exact copies, repeated rows) are one leaf.
    A null doc_id gets a component and never names one; alone in it, its
    component is null. Other columns of docs play no part. An empty table gives
    an empty result.
    """
    prints, named = _groups(docs, text, doc_id)
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of = named.join(ids, "fp")
    by_print = of.join(of.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs, of each near-duplicate group one row: of the smallest id, null last, and of rows that share it one of the least text hash.

    Rows that share an id but not a group are documents of their own. Null,
    empty and blank texts are one group. An empty table gives an empty result.
    """
    prints, named = _groups(docs, text, doc_id)
    first = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"))
    keep = named.join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    # a null id stands as the text, and others behind a sign that tells them from it
    key = lambda c: F.coalesce(F.concat(F.lit("i"), c.cast("string")), F.lit(""))
    keep = keep.select(key(F.col("first.doc_id")).alias("__id"), F.col("first.th").alias("__th"))
    own = docs.withColumns({"__id": key(F.col(doc_id).cast("long")), "__th": F.xxhash64(F.col(text).cast("string"))})
    return own.join(keep.hint("merge"), ["__id", "__th"], "left_semi").dropDuplicates(["__id", "__th"]).select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
