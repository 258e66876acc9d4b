"""Byte-level BPE by recursive DuckDB queries, one connection for each Python worker.

A batch's texts are split by the tokenizer's pattern; the pieces that the worker
has not met yet become token-position rows, one per byte. A recursive query
joins neighbouring rows with the merge table (left, right -> merged rank) and
contracts each piece's leftmost pair of least rank until no pair is left. In
pieces over LONG_PIECE bytes a step contracts every pair of the least rank from
left to right, where that comes to the same; see _LONG. Decoding joins a
document's ids with the vocabulary and aggregates their bytes in order.

The merge table holds every split of every token into two tokens: a pair's rank
is the rank of its bytes put together, however these came about.
"""

from __future__ import annotations

import base64
import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: Bytes up to which a position fits the six bits that _ENCODE's key has for it.
LONG_PIECE = 63
#: Steps of one query over long pieces, whose recursion keeps every step's rows; what is not done then goes into the next query.
LONG_STEPS, LONG_BYTES = 16, 100_000
#: Units whose ids a worker remembers; beyond that it keeps those met again, half as many at most.
REMEMBERED = 300_000
#: Characters that are encoded together, at least one text.
PART_CHARS = 1_500_000
#: Units kept from one task to the next, those met most.
KEPT = 50_000
#: Pieces that one recursive query contracts.
PIECES = 20_000

#: A row is a token at pp, its piece * 64 and its byte's position (under 64, see LONG_PIECE), with its right neighbour (nxt at
#: npp); key is the rank of the pair the two make, then pos, or null. The merge table's key is left * 1048576 + right: every
#: join is on one column. A step contracts the pair of least key and joins only the neighbours it changed.
_ENCODE = """WITH RECURSIVE t(step, pp, tok, nxt, npp, key) AS (
  SELECT 0::INTEGER, s.pp, s.tok, s.nxt, (s.pp + 1)::INTEGER, m.rank * 64 + (s.pp & 63)
  FROM start s LEFT JOIN merges m ON s.tok::BIGINT * 1048576 + s.nxt = m.pair
  UNION ALL
  SELECT n.step, n.pp, n.tok, n.nxt, n.npp, CASE WHEN n.same THEN n.key ELSE m.rank * 64 + (n.pp & 63) END
  FROM (
    SELECT (t.step + 1)::INTEGER AS step, t.pp,
      CASE WHEN t.pp = b.pp THEN b.rank ELSE t.tok END AS tok,
      CASE WHEN t.pp = b.pp THEN r.nxt WHEN t.npp = b.pp THEN b.rank ELSE t.nxt END AS nxt,
      CASE WHEN t.pp = b.pp THEN r.npp ELSE t.npp END AS npp, t.key, t.pp <> b.pp AND t.npp <> b.pp AS same
    FROM t JOIN (SELECT pp >> 6 AS piece, min(key) // 64 AS rank, ((pp >> 6) << 6) + min(key) % 64 AS pp, arg_min(npp, key) AS gone FROM t WHERE key IS NOT NULL GROUP BY pp >> 6) b ON t.pp >> 6 = b.piece
      JOIN t r ON r.pp = b.gone
    WHERE t.pp <> b.gone) n
  LEFT JOIN merges m ON CASE WHEN n.same THEN -1 ELSE n.tok::BIGINT * 1048576 + n.nxt END = m.pair
)
SELECT t.pp >> 6 AS piece, tok FROM t JOIN (SELECT pp >> 6 AS piece, max(step) AS step FROM t WHERE pp & 63 = 0 GROUP BY pp >> 6) x ON t.pp >> 6 = x.piece AND t.step = x.step ORDER BY t.pp
"""

#: One step contracts all pairs of the piece's least rank from left to right, of overlapping ones every other. That is what
#: contracting the leftmost again and again comes to, unless the new token makes a pair of lower rank with a neighbour: it
#: can only if it is `loose`, and then the leftmost alone is contracted. A row's rank is that of its pair with the next row.
_LONG = """WITH RECURSIVE t(step, piece, pos, tok, rank) AS (
  SELECT 0, s.piece, s.pos, s.tok, m.rank FROM (SELECT *, lead(tok) OVER (PARTITION BY piece ORDER BY pos) AS nxt FROM start) s LEFT JOIN merges m ON s.tok::BIGINT * 1048576 + s.nxt = m.pair
  UNION ALL
  SELECT n.step, n.piece, n.pos, n.tok, m.rank FROM (
    SELECT step + 1 AS step, piece, pos, CASE WHEN take THEN least ELSE tok END AS tok, lead(CASE WHEN take THEN least ELSE tok END) OVER (PARTITION BY piece ORDER BY pos) AS nxt
    FROM (SELECT *, coalesce(lag(take) OVER (PARTITION BY piece ORDER BY pos), false) AS gone FROM (
      SELECT *, hit AND row_number() OVER (PARTITION BY piece, hit, run ORDER BY pos) % 2 = 1 AND (nth = 1 OR least NOT IN (SELECT tok FROM loose)) AS take FROM (
        SELECT *, row_number() OVER (PARTITION BY piece ORDER BY pos) - row_number() OVER (PARTITION BY piece, hit ORDER BY pos) AS run, row_number() OVER (PARTITION BY piece, hit ORDER BY pos) AS nth FROM (
          SELECT *, coalesce(rank = least, false) AS hit FROM (SELECT *, min(rank) OVER (PARTITION BY piece) AS least FROM t) WHERE least IS NOT NULL AND step < $steps))))
    WHERE NOT gone) n
  LEFT JOIN merges m ON n.tok::BIGINT * 1048576 + n.nxt = m.pair
)
SELECT piece, pos, tok, rank IS NOT NULL AS open FROM t JOIN (SELECT piece, max(step) AS step FROM t GROUP BY piece) USING (piece, step) ORDER BY piece, pos
"""

#: The vocabulary's bytes stand as characters of the same code, one a byte: only texts can be put together in order.
_DECODE = """
SELECT seq, string_agg(s, '') AS s FROM (SELECT i.seq, v.s FROM ids i JOIN vocab v ON i.tok = v.tok ORDER BY i.pos) GROUP BY seq ORDER BY seq
"""


class Tokenizer:
    """Ranks, merge table and remembered units of one vocabulary, in one process."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        ranks = self.ranks
        merges: list[tuple[int, int, int]] = []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    merges.append((a, b, rank))
        self.byte = [ranks[bytes([i])] for i in range(256)]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "preserve_insertion_order": False})
        rows = np.array(merges, dtype=np.int32).reshape(-1, 3)
        self._table("merge_rows", pair=rows[:, 0].astype(np.int64) * 1048576 + rows[:, 1], rank=rows[:, 2])
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        # tokens that can stand in a pair of lower rank than their own
        self._table("loose_rows", tok=np.unique(np.concatenate([rows[rows[:, 2] < rows[:, k], k] for k in (0, 1)])))
        self.con.execute("CREATE TABLE loose AS SELECT * FROM loose_rows")
        self._table("vocab_rows", tok=np.array(list(ranks.values()), dtype=np.int32), s=[t.decode("latin-1") for t in ranks])
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM vocab_rows")
        self.forget()

    def _table(self, name: str, **columns) -> None:
        self.con.register(name, pa.table({k: pa.array(v) for k, v in columns.items()}))

    def forget(self) -> None:
        """Drop the remembered units. Unit i has ids[starts[i] : starts[i + 1]]."""
        self.units: dict[str, int] = {}
        self.seen = np.empty(0, dtype=np.int64)
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.empty(0, dtype="<u4")

    def keep(self, most: int) -> None:
        """Forget units but those met again since they were learned, and of these all but the `most` met most; what is kept ages."""
        again = np.flatnonzero(self.seen > 1)
        if len(again) > most:
            again = np.sort(again[np.argpartition(-self.seen[again], most)[:most]])
        mask = np.zeros(len(self.units), dtype=bool)
        mask[again] = True
        self.units = {u: i for i, u in enumerate(compress(self.units, mask.tolist()))}
        self.seen = self.seen[again] // 2
        self.ids, self.starts = _gather(self.ids, self.starts, again)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in a row, and where each piece's begin and the last's end."""
        which, found, rest, long = [], [], [], []
        for i, p in enumerate(pieces):
            one = self.ranks.get(p)  # as the tokenizer does: a piece that is a token stays whole
            if one is not None:
                which.append(i)
                found.append(one)
            elif len(p) > LONG_PIECE:
                long.append(i)
            else:
                rest.append(i)
        owner, ids = [np.array(which, dtype=np.int64)], [np.array(found, dtype=np.int32)]
        table, index = np.array(self.byte, dtype=np.int32), np.array(rest, dtype=np.int64)
        for at in range(0, len(rest), PIECES):
            some = rest[at : at + PIECES]
            sizes = np.array([len(pieces[i]) for i in some])
            raw = np.frombuffer(b"".join([pieces[i] for i in some]), dtype=np.uint8)
            pos = (np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            tok = table[raw]
            nxt = np.append(tok[1:], np.int32(-1))
            nxt[np.cumsum(sizes) - 1] = -1
            self._table("start", pp=np.repeat(np.arange(len(some), dtype=np.int32), sizes) * np.int32(64) + pos, tok=tok, nxt=nxt)
            got = self.con.sql(_ENCODE).to_arrow_table()
            self.con.unregister("start")
            owner.append(index[at + got.column(0).to_numpy()])
            ids.append(got.column(1).to_numpy())
        at = 0
        while at < len(long):
            end, size = at + 1, len(pieces[long[at]])
            while end < len(long) and size + len(pieces[long[end]]) <= LONG_BYTES:
                size += len(pieces[long[end]])
                end += 1
            for k, own in enumerate(self._contract_long([pieces[i] for i in long[at:end]])):
                owner.append(np.full(len(own), long[at + k]))
                ids.append(own)
            at = end
        who = np.concatenate(owner)
        order = np.argsort(who, kind="stable")
        return np.concatenate(ids)[order], np.searchsorted(who[order], np.arange(len(pieces) + 1))

    def _contract_long(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece, of any length: LONG_STEPS steps a query, until no piece holds a pair of the merge table."""
        table = np.array(self.byte, dtype=np.int32)
        out: list[np.ndarray] = [table[np.frombuffer(p, dtype=np.uint8)] for p in pieces]
        todo = list(range(len(pieces)))
        while todo:
            sizes = [len(out[i]) for i in todo]
            pos = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            self._table("start", piece=np.repeat(np.array(todo, dtype=np.int32), sizes), pos=pos, tok=np.concatenate([out[i] for i in todo]))
            got = self.con.sql(_LONG, params={"steps": LONG_STEPS}).to_arrow_table()
            self.con.unregister("start")
            piece, tok = got.column("piece").to_numpy(), got.column("tok").to_numpy()
            cut = np.searchsorted(piece, todo + [len(pieces)])
            for i, a, b in zip(todo, cut[:-1], cut[1:], strict=True):
                out[i] = tok[a:b]
            todo = np.unique(piece[got.column("open").to_numpy()]).tolist()
        return out

    def decode_runs(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The bytes of each run ids[starts[i] : starts[i + 1]]; an empty run has none."""
        runs = len(starts) - 1
        self._table("ids", seq=np.repeat(np.arange(runs, dtype=np.int32), np.diff(starts)), pos=np.arange(len(ids), dtype=np.int32), tok=ids.astype(np.int32))
        got = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("ids")
        out = [b""] * runs
        for i, s in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
            out[i] = s.encode("latin-1")
        return out

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """The bytes of each sequence of ids; an empty sequence has none."""
        flat = np.fromiter((i for x in ids for i in x), dtype=np.int64)
        return self.decode_runs(flat, np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64))

    def split(self, text: str) -> list[str]:
        """Units of text that the pattern never matches across.

        A match holds white space at its start alone, or is white space. So a
        text whose white space is single spaces and line feeds between other
        characters may be cut before each space and around each line feed;
        others, and a text with a zero character, are cut into matches.
        """
        words = text.split()
        gaps = max(0, len(words) - 1)
        if "\0" in text or len("".join(words)) + gaps != len(text) or text.count(" ") + text.count("\n") != gaps:
            return self.pattern.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if text else []

    def learn(self, new: list[str]) -> None:
        """Encode units not met before, each once in new, and remember them."""
        split = list(map(self.pattern.findall, new))
        flat = [p for s in split for p in s]
        pieces = {p: i for i, p in enumerate(dict.fromkeys(flat))}
        ids, starts = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in pieces])
        self.units.update(zip(new, range(len(self.units), len(self.units) + len(new)), strict=True))
        k = np.array(list(map(pieces.__getitem__, flat)), dtype=np.int64)
        ends = np.cumsum(list(map(len, split)))
        ids, at = _gather(ids, starts, k)
        self.starts = np.concatenate((self.starts, self.starts[-1] + at[ends]))
        self.ids = np.concatenate((self.ids, ids.astype("<u4")))
        self.seen = np.append(self.seen, np.zeros(len(new), dtype=np.int64))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (unsigned, 32 bits), and where each text's begin and end; null counts as empty."""
        if len(self.units) > REMEMBERED:
            self.keep(REMEMBERED // 2)
        split = [self.split(t or "") for t in texts]
        flat = [u for s in split for u in s]
        at = list(map(self.units.get, flat))
        if None in at:
            self.learn(list(dict.fromkeys(u for u, i in zip(flat, at, strict=True) if i is None)))
            at = list(map(self.units.get, flat))
        k = np.array(at, dtype=np.int64)
        self.seen += np.bincount(k, minlength=len(self.units))
        ids, ends = _gather(self.ids, self.starts, k)
        units = np.concatenate(([0], np.cumsum([len(s) for s in split]))).astype(np.int64)
        return ids, ends[units]


def _gather(values: np.ndarray, starts: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[starts[i] : starts[i + 1]] of each i in k, in a row, and where each begins and the last ends."""
    size = starts[k + 1] - starts[k]
    ends = np.concatenate(([0], np.cumsum(size)))
    return values[np.repeat(starts[k] - ends[:-1], size) + np.arange(ends[-1])], ends


def _trim() -> None:
    """Give free memory back to the system, where the C library can: a worker that waits for its next task holds what it remembers only."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_made: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(path: str | None, pattern: str | None) -> Tokenizer:
    """This process' tokenizer for a rank file, without one the public vocabulary as installed here: built once, kept from task to task."""
    if path is None:
        path, pattern = _vocabulary()
    if (path, pattern) not in _made:
        _made[path, pattern] = Tokenizer(path, pattern)
    return _made[path, pattern]


def _vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None, ids: bool = True) -> DataFrame:
    """docs without text, with n_tokens, ids (array of int; left out unless wanted), ids_sha256 and decoded_sha256.

    path is a rank file that every worker can read. A null text is empty: no
    ids. Texts are encoded whole, each row alone, so repeated rows get equal
    ids; an empty table gives an empty result. Columns of docs named like a new
    one are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "n_tokens", "ids", "ids_sha256", "decoded_sha256")]
    own = docs.select(F.col(text).cast("string").alias("t"), F.struct(F.lit(0).alias("__none"), *rest).alias("rest"))
    kind = own.schema["rest"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for b in batches:
            # the batch's new units are contracted together, by few queries
            texts = b.column(0).to_pylist()
            size, at = 0, 0
            for i in range(len(texts) + 1):
                size += len(texts[i] or "") if i < len(texts) else 0
                if i < len(texts) and size < PART_CHARS:
                    continue
                part = texts[at : i + 1]
                flat, bounds = tok.encode(part)
                back = tok.decode_runs(flat, bounds)
                raw, cut = flat.tobytes(), (4 * bounds).tolist()
                hashes = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                columns = [pa.array(np.diff(bounds), pa.int64()), pa.array(hashes, pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()), b.column(1).slice(at, len(part))]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32))))
                if part:
                    yield pa.RecordBatch.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256", "rest", *["ids"] * ids])
                size, at = 0, i + 1
        if len(tok.units) > KEPT:  # an idle worker keeps what it holds
            tok.keep(KEPT)
        _trim()

    out = own.mapInArrow(run, f"n_tokens long, ids_sha256 string, decoded_sha256 string, rest {kind}" + ", ids array<int>" * ids)
    return out.select(*[F.col("rest").getField(c).alias(c) for c in rest], "n_tokens", *["ids"] * ids, "ids_sha256", "decoded_sha256")


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """rows with `decoded` (binary) in place of ids; null or no ids: no bytes. An id outside the vocabulary decodes to nothing."""
    rest = [c for c in rows.columns if c not in (ids, "decoded")]
    own = rows.select(F.col(ids).cast("array<long>").alias("i"), F.struct(F.lit(0).alias("__none"), *rest).alias("rest"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, pattern)
        for b in batches:
            got = tok.decode([x or [] for x in b.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary()), b.column(1)], names=["decoded", "rest"])

    out = own.mapInArrow(run, f"decoded binary, rest {own.schema['rest'].dataType.simpleString()}")
    return out.select(*[F.col("rest").getField(c).alias(c) for c in rest], "decoded")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents").select("doc_id", "text"), ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
