"""Language identification by interpolated Kneser-Ney character models.

Counts of 4-grams of characters are taken over all documents that may be learnt
from and summed by Spark. A language's highest order uses them, lower orders the
numbers of different characters before an n-gram. Totals, continuation counts and
probabilities are taken in Spark over all n-grams, of which every one is kept.
All languages' n-grams of an order share one sorted array of 64-bit hashes; beside it stand each language's
log probabilities, backed off already where that language lacks the n-gram, so
one binary search serves all. The language of least cross-entropy per character
wins; beyond a threshold calibrated on texts that were not counted it is rejected.

The arrays are cut into shards of bounded size by the two symbols before a
predicted one, which every table of order 3 and more knows; the small tables of
lower orders are in each. A task looks each position up in its shard and holds
one shard at a time; so does the driver, which hands them on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, materialize, read

ORDER, DISCOUNT = 4, 0.75
#: Texts of a language that are kept from counting, for the calibration of rejection and confidence: at most so many, and one in ten.
CALIBRATION_ROWS, CALIBRATION_SHARE = 500, 0.1
START = 1
_M = 0x9E3779B97F4A7C15
_CHUNK = 1_000_000
#: Leading bits of a hash that the directory of a sorted array is kept by.
_BITS = 20
_SYMBOL = (1 << 21) - 1
_SPAN = 1 << 30
#: Bytes of a model's arrays in one shard, about; characters of text that a task takes through all shards at once.
SHARD_BYTES, GROUP_CHARS = 1 << 27, 1 << 25

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters as code points, lower case, each run of other characters than letters one 0; three STARTs before each text. And each text's first index."""
    lower = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in lower], dtype=np.int64)
    raw = np.frombuffer("".join(["\0\0\0" + t for t in lower]).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    starts = np.cumsum(sizes + 3) - sizes - 3
    code = np.where(_letter_table()[raw], raw, 0)
    pad = np.zeros(len(code), dtype=bool)
    for k in range(3):
        pad[starts + k] = True
    code[pad] = START
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    at = np.concatenate(([0], np.cumsum(keep)))[starts]
    return code[keep], at


def hashes(c: np.ndarray, order: int) -> np.ndarray:
    """Hash of the `order` symbols up to each index (wrong for the first order - 1, which are STARTs of no use)."""
    with np.errstate(over="ignore"):
        h = np.full(len(c), order, dtype=np.uint64)
        for k in range(order - 1, -1, -1):
            own = np.zeros(len(c), dtype=np.uint64)
            own[k:] = c[: len(c) - k] if k else c
            h = (h ^ own) * np.uint64(_M)
            h ^= h >> np.uint64(32)
        return h


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    """hashes() of n-grams given as rows."""
    with np.errstate(over="ignore"):
        h = np.full(len(rows), rows.shape[1], dtype=np.uint64)
        for k in range(rows.shape[1]):
            h = (h ^ rows[:, k].astype(np.uint64)) * np.uint64(_M)
            h ^= h >> np.uint64(32)
        return h


def _count(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different 4-grams of c that do not end in a START, as rows, and their numbers: symbols are numbered densely, four fill one word."""
    bits = 16
    alphabet = np.unique(c)
    if len(alphabet) > 1 << bits:
        fine = np.flatnonzero(c[3:] != START)
        return np.unique(np.column_stack([c[k:][fine] for k in range(4)]), axis=0, return_counts=True)
    table = np.zeros(int(alphabet[-1]) + 1, dtype=np.uint64)
    table[alphabet] = np.arange(len(alphabet), dtype=np.uint64)
    d = table[c]
    pack = (d[:-3] << np.uint64(48)) | (d[1:-2] << np.uint64(32)) | (d[2:-1] << np.uint64(16)) | d[3:]
    kinds, n = np.unique(pack[c[3:] != START], return_counts=True)
    return alphabet[np.column_stack([(kinds >> np.uint64(k)).astype(np.int64) & 0xFFFF for k in (48, 32, 16, 0)])], n


def ngram_counts(docs: DataFrame) -> DataFrame:
    """docs: lang, text. (lang, a, b, n): counts of 4-grams; a packs the first three symbols, b is the fourth."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                mine, size, held = [t for x, t in zip(langs, texts, strict=True) if x == lang], 0, []
                for i, t in enumerate(mine):
                    held.append(t)
                    size += len(t or "")
                    if size < _CHUNK and i + 1 < len(mine):
                        continue
                    c, _ = symbols(held)
                    grams, n = _count(c)
                    a = (grams[:, 0] << 42) | (grams[:, 1] << 21) | grams[:, 2]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(a), pa.array(grams[:, 3]), pa.array(n.astype(np.int64))], names=["lang", "a", "b", "n"])
                    held, size = [], 0

    return docs.select("lang", "text").mapInArrow(run, "lang string, a long, b long, n long").groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))


@dataclass
class Shard:
    """The model's arrays for the symbols whose two predecessors fall into shard `number` of `of`."""

    number: int
    of: int
    langs: int
    #: by order 1..4: sorted hashes; by order 1..3: log probabilities (n-grams by languages)
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    #: by context length 1..3: sorted hashes, and log back-off weights, with a row of zeros last for contexts never met
    ctx: list[np.ndarray]
    back: list[np.ndarray]
    floor: np.ndarray
    #: of order 4: each language's log probabilities, with a zero last
    columns: list
    directory: list | None = None

    def nats(self, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Nats of this shard's symbols of each text in each language."""
        out = np.zeros((len(starts), self.langs))
        wanted = c != START
        if self.of > 1:
            mine = np.zeros(len(c), dtype=bool)
            mine[2:] = ((c[:-2] << 21) | c[1:-1]) % self.of == self.number
            wanted &= mine
        i, rest = self._locate(ORDER, hashes(c, ORDER), wanted)
        for k in range(self.langs):
            own = self.columns[k][i]  # the last row, of zeros, stands for what is not scored here
            out[:, k] = -np.add.reduceat(own, starts, dtype=np.float64)
        if len(rest):
            doc = np.searchsorted(starts, rest, side="right") - 1
            lp = self._lower(c, rest)
            for k in range(self.langs):
                out[:, k] -= np.bincount(doc, lp[:, k], len(starts))
        return out

    def prepare(self) -> None:
        """What lookups need besides the sorted arrays: a directory by the hashes' leading bits."""
        self.directory = [np.searchsorted(k, np.arange(1 << _BITS, dtype=np.uint64) << np.uint64(64 - _BITS)).astype(np.int32) for k in self.keys]

    def _locate(self, order: int, h: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The row of each hash, the number of rows where there is none; and the indices of the wanted ones without."""
        keys = self.keys[order - 1]
        last = len(keys) - 1
        i = self.directory[order - 1][h >> np.uint64(64 - _BITS)]
        np.minimum(i, last, out=i)
        off = keys[i] != h
        if wanted is not None:
            i[~wanted] = last + 1
            off &= wanted
        todo = np.flatnonzero(off)
        missing = []
        while len(todo):  # hashes that share their leading bits stand side by side
            go = (keys[i[todo]] < h[todo]) & (i[todo] < last)
            missing.append(todo[~go])
            todo = todo[go]
            i[todo] += 1
            todo = todo[keys[i[todo]] != h[todo]]
        rest = np.sort(np.concatenate(missing)) if missing else np.empty(0, dtype=np.int64)
        i[rest] = last + 1
        return i, rest

    def _lower(self, c: np.ndarray, todo: np.ndarray) -> np.ndarray:
        """Log probabilities at indices whose n-gram of top order no language knows."""
        lp = np.zeros((len(todo), self.langs))
        at = np.arange(len(todo))
        for order in range(ORDER - 1, -1, -1):
            g = _hash_rows(np.column_stack([c[todo - k] for k in range(order, 0, -1)])) if order else None
            if order:
                ctx = self.ctx[order - 1]
                i = np.minimum(np.searchsorted(ctx, g), len(ctx) - 1)
                lp[at] += self.back[order - 1][np.where(ctx[i] == g, i, len(ctx))]
                i, rest = self._locate(order, _hash_rows(np.column_stack([c[todo - k] for k in range(order - 1, -1, -1)])))
                hit = i < len(self.keys[order - 1])
                lp[at[hit]] += self.logp[order - 1][i[hit]]
                todo, at = todo[rest], at[rest]
                if not len(todo):
                    break
            else:
                lp[at] += self.floor
        return lp


@dataclass
class Model:
    langs: list[str]
    #: shards, or broadcasts of them
    shards: list
    reject: np.ndarray
    #: how fast the winner's share grows with its lead in nats per symbol
    sharp: float = 8.0

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol of each text in each language, and the number of letters. Shards are taken one after the other."""
        out, letters, scored = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64), np.ones(len(texts), dtype=np.int64)
        for sent in self.shards:
            shard = sent.value if isinstance(sent, Broadcast) else sent
            if shard.directory is None:
                shard.prepare()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= _CHUNK):
                    size += len(texts[end] or "")
                    end += 1
                c, starts = symbols(texts[at:end])
                if sent is self.shards[0]:
                    scored[at:end] = np.maximum(1, np.add.reduceat((c != START).astype(np.int64), starts))
                    letters[at:end] = np.add.reduceat((c > START).astype(np.int64), starts)
                out[at:end] += shard.nats(c, starts)
                at = end
            if len(self.shards) > 1 and isinstance(sent, Broadcast) and hasattr(sent, "_value"):
                del shard, sent._value  # a task holds one shard; it is read again from the executor's disk
        return out / scored[:, None], letters

    def answers(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """lang_pred, score, entropy and rejected of each text."""
        e, n = self.entropies(texts)
        k = e.argmin(axis=1)
        best = e[np.arange(len(k)), k]
        none = n == 0
        share = 1 / np.exp(-self.sharp * (e - best[:, None])).sum(axis=1)
        return ["und" if x else self.langs[i] for x, i in zip(none, k, strict=True)], np.where(none, 0.0, share), best, none | (best > self.reject[k])


def _hashed(rows: DataFrame, size: int) -> DataFrame:
    """h, and the logs of each language's value. rows: a (size symbols, packed), b if the n-gram has one more, and the values."""
    last = int("b" in rows.columns)
    names = rows.columns[1 + last :]

    def run(batches):
        for x in batches:
            a = x.column(0).to_numpy()
            grams = [(a >> (21 * k)) & _SYMBOL for k in range(size - 1, -1, -1)] + [x.column(1).to_numpy()] * last
            logs = [pa.array(np.log(x.column(k).to_numpy()).astype(np.float32)) for k in range(1 + last, x.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array(_hash_rows(np.column_stack(grams)).view(np.int64)), *logs], names=["h", *names])

    return rows.mapInArrow(run, ", ".join(["h long", *(f"{x} float" for x in names)]))


def _gather(rows: DataFrame, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """_hashed() as arrays sorted by hash; of nothing, a row that no n-gram finds."""
    t = _hashed(rows, size).toArrow()
    h = t.column(0).to_numpy().view(np.uint64)
    if not len(h):
        return np.array([~np.uint64(0)]), [np.zeros(1, dtype=np.float32) for _ in t.columns[1:]]
    o = np.argsort(h)
    return h[o], [c.to_numpy()[o] for c in t.columns[1:]]


class Tables:
    """A model's probabilities and back-off weights as tables of the shared folder, and the shards cut from them."""

    def __init__(self, counts: DataFrame):
        """counts: lang, a, b, n. No language where there is no n-gram."""
        by, most = {ORDER: counts}, counts.count()  # no table below has more rows
        # of few rows, many partitions cost more than they save; a task's rows stay bounded
        tasks = max(8, most >> 17)
        for order in range(ORDER - 1, 0, -1):  # in how many different symbols' company an n-gram follows
            suffix = F.col("a").bitwiseAND(F.lit((1 << 21 * (order - 1)) - 1).cast("long"))
            by[order] = materialize(by[order + 1].groupBy("lang", suffix.alias("a"), "b").agg(F.count(F.lit(1)).alias("n")).coalesce(tasks), f"langid-counts-{order}")
        first = {r["lang"]: (r["total"], r["kinds"]) for r in by[1].groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).collect()}
        self.langs = sorted(first)
        if not first:
            return
        base = 1.0 / (max(kinds for _, kinds in first.values()) + 1 + 256)  # room for symbols never met
        self.floor = np.array([DISCOUNT * first[x][1] / first[x][0] * base for x in self.langs])
        js = range(len(self.langs))

        def per(use, value: Column, name: str) -> list[Column]:
            return [use(F.when(F.col("lang") == x, value)).alias(f"{name}{j}") for j, x in enumerate(self.langs)]

        self.grams: dict[int, DataFrame] = {}
        self.contexts: dict[int, DataFrame] = {}
        for order in range(1, ORDER + 1):
            grams = by[order].groupBy("a", "b").agg(*per(F.sum, F.col("n"), "n"))
            if order == 1:
                p = [F.coalesce((F.col(f"n{j}") - DISCOUNT) / first[self.langs[j]][0], F.lit(0.0)) + F.lit(float(self.floor[j])) for j in js]
            else:
                sums = by[order].groupBy("a").agg(*per(F.sum, F.col("n"), "t"), *per(F.count, F.lit(1), "k"))
                gamma = [F.when(F.col(f"t{j}") > 0, F.lit(DISCOUNT) * F.col(f"k{j}") / F.col(f"t{j}")).otherwise(1.0).alias(f"g{j}") for j in js]
                contexts = self.contexts[order - 1] = materialize(sums.select("a", *gamma, *[f"t{j}" for j in js]).coalesce(tasks), f"langid-contexts-{order}")
                low = self.grams[order - 1].select(F.col("a").alias("low_a"), F.col("b").alias("low_b"), *[F.col(f"p{j}").alias(f"l{j}") for j in js])
                suffix = F.col("a").bitwiseAND(F.lit((1 << 21 * (order - 2)) - 1).cast("long"))
                grams = grams.join(contexts, "a").join(low, (suffix == F.col("low_a")) & (F.col("b") == F.col("low_b")))
                p = [F.when(F.col(f"n{j}") > 0, F.greatest(F.col(f"n{j}") - DISCOUNT, F.lit(0.0)) / F.col(f"t{j}")).otherwise(0.0) + F.col(f"g{j}") * F.col(f"l{j}") for j in js]
            self.grams[order] = materialize(grams.select("a", "b", *[x.alias(f"p{j}") for j, x in enumerate(p)]).coalesce(tasks), f"langid-model-{order}")
        # all tables together hold some three times the rows of the largest, at most
        self.of = max(1, -(-3 * most * (8 + 4 * len(self.langs)) // SHARD_BYTES))

    def shard(self, number: int) -> Shard:
        """One shard, fetched to the driver."""

        def mine(rows: DataFrame) -> DataFrame:
            return rows.where(F.col("a").bitwiseAND(F.lit((1 << 42) - 1).cast("long")) % self.of == number) if self.of > 1 else rows

        n = len(self.langs)
        keys, logp, ctx, back = [], [], [], []
        for size in range(1, ORDER):
            rows = self.contexts[size].select("a", *[f"g{j}" for j in range(n)])
            h, weights = _gather(mine(rows) if size > 1 else rows, size)
            ctx.append(h)
            back.append(np.append(np.column_stack(weights), np.zeros((1, n), dtype=np.float32), axis=0))
        for order in range(1, ORDER + 1):
            h, logs = _gather(mine(self.grams[order]) if order > 2 else self.grams[order], order - 1)
            keys.append(h)
            logp.append(np.column_stack(logs) if order < ORDER else None)
        return Shard(number, self.of, n, keys, logp[:-1], ctx, back, np.log(self.floor), [np.append(x, np.float32(0)) for x in logs])


def _calibrated(model: Model, nats: np.ndarray, letters: np.ndarray, lang: np.ndarray) -> None:
    """Set reject and sharp by the entropies of texts that were not counted. lang: each text's own language."""
    fine = letters > 0
    own = nats[np.arange(len(lang)), lang]
    mean = {j: own[fine & (lang == j)].mean() for j in np.unique(lang[fine]).tolist()}
    if mean:  # how far texts lie above their language's mean is taken over all languages
        above = own[fine] - np.array([mean[j] for j in lang[fine].tolist()])
        for j, x in mean.items():
            model.reject[j] = x + np.quantile(above, 0.99) + 2 * above.std()
    if not fine.any():
        return
    gap, lang = (nats - own[:, None])[fine], lang[fine]
    few = 1 / (len(lang) + 2)  # as if one text more were mistaken: else a clean sample asks for certainty

    def likelihood(sharp: float) -> float:
        worst = np.logaddexp.reduce(-sharp * gap, axis=1)
        wrong = np.where(np.arange(nats.shape[1]) == lang[:, None], np.inf, gap).min(axis=1, initial=np.inf)
        return float((-worst * (1 - few)).sum() + (few * (-sharp * np.where(np.isfinite(wrong), wrong, 0) - worst)).sum())

    model.sharp = float(max(np.geomspace(0.5, 200, 80), key=likelihood))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id") -> Model | None:
    """A model of each non-null lang of docs; None without any n-gram.

    Counts cover every document but the calibration's, and every n-gram is
    kept. A language's calibration texts are those of least hash of id and
    text, about CALIBRATION_ROWS and CALIBRATION_SHARE of its documents at
    most; a language of under ten documents has none, and never rejects.
    """
    own = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.pmod(F.xxhash64(doc_id, text), F.lit(_SPAN)).alias("h"))
    n = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return None
    cuts = F.create_map(*[F.lit(x) for k, m in n.items() for x in (k, int(_SPAN * min(CALIBRATION_SHARE, CALIBRATION_ROWS / m)) if m >= 1 / CALIBRATION_SHARE else 0)])
    kept = F.col("h") < F.try_element_at(cuts, F.col("lang"))
    tables = Tables(materialize(ngram_counts(own.where(~kept)), "langid-counts"))
    if not tables.langs:
        return None
    picked = sorted((r["lang"], r["text"]) for r in own.where(kept).select("lang", "text").distinct().collect() if r["lang"] in tables.langs)
    model = Model(tables.langs, [], np.full(len(tables.langs), np.inf))
    texts, nats = [t for _, t in picked], np.zeros((len(picked), len(tables.langs)))
    letters = np.zeros(len(picked), dtype=np.int64)
    for k in range(tables.of):
        shard = tables.shard(k)
        if texts:
            more, letters = Model(tables.langs, [shard], model.reject).entropies(texts)
            nats += more
        shard.directory = None  # made again where it is needed: cheaper than sending it
        model.shards.append(docs.sparkSession.sparkContext.broadcast(shard))
        del shard
    _calibrated(model, nats, letters, np.array([tables.langs.index(x) for x, _ in picked], dtype=np.int64))
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs without text, with lang_pred, score (the winner's share, 0 to 1), entropy (nats per symbol) and rejected.

    lang_pred is `und`, with score 0, where the text is null or has no letter,
    and everywhere if nothing could be learnt. Ties go to the first language by
    code point. Each row alone; columns of docs named like a new one are replaced.
    """
    new = ("lang_pred", "score", "entropy", "rejected")
    rest = [c for c in docs.columns if c not in (text, *new)]
    own = docs.select(F.col(text).cast("string").alias("t"), F.struct(F.lit(0).alias("__none"), *rest).alias("rest"))

    def run(batches):
        held, size = [], 0

        def flush():
            texts = [t for b in held for t in b.column(0).to_pylist()]
            if model is None or not texts:
                pred, score, best, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            else:
                pred, score, best, rejected = model.answers(texts)
            at = 0
            for b in held:
                end = at + b.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(pred[at:end], pa.string()), pa.array(score[at:end]), pa.array(best[at:end]), pa.array(rejected[at:end]), b.column(1)], names=[*new, "rest"])
                at = end

        # one shard serves batch by batch; of more, each is read once a group
        most = GROUP_CHARS if model is not None and len(model.shards) > 1 else 0
        for b in batches:
            held.append(b)
            size += b.column(0).nbytes
            if size >= most:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    out = own.mapInArrow(run, f"lang_pred string, score double, entropy double, rejected boolean, rest {own.schema['rest'].dataType.simpleString()}")
    return out.select(*[F.col("rest").getField(c).alias(c) for c in rest], *new)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(crc_mod(F.col("doc_id"), 5) != 0))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")
