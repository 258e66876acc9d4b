"""The training-data operators: oracle, brute force, exact round trips, held-out accuracy, and odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import bpe, chat, langid, line_dedup, mixing, quality_classifier, quality_rules, registry, simhash, topk, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, ids string"
ODD = [(1, None, None, None, 0, "x", "y", "z"), (2, "", "en", "a", 0, None, None, None), (3, " \n\t ", "en", "a", 4, None, None, None), (4, "same text here. " * 3, "en", "b", 48, None, None, None), (4, "same text here. " * 3, "en", "b", 48, None, None, None), (None, "no id", "de", "b", 5, None, None, None), (9, "w" * 5000 + " é日 " + "word " * 4000, "fr", None, 25_004, None, None, None)]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, against, name):
    against(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF)


def _components(fps):
    u = np.unique(fps)
    up = list(range(len(u)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[:i] ^ u[i]) <= 3):
            up[root(i)] = root(int(j))
    return {int(x): root(i) for i, x in enumerate(u)}


def test_trie_join_finds_all_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 20, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 20, dtype=np.uint64)) for _ in range(15)]))
    want = _components(fps)
    got = simhash._join([(k, fps) for k in range(4)])
    up = {int(x): int(x) for x in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in zip(got["a"].to_numpy().view(np.uint64).tolist(), got["b"].to_numpy().view(np.uint64).tolist(), strict=True):
        assert want[a] == want[b]
        up[root(a)] = root(b)
    assert len({root(int(x)) for x in fps}) == len(set(want.values()))


@pytest.mark.parametrize("unit", [1, 6, 50])
def test_large_nodes_are_opened(spark, unit):
    """Clouds of fingerprints round two centres, and others; nodes opened over many levels find the links of all pairs."""
    rng = np.random.default_rng(5)
    near = [c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 4)).tolist())) for c in (0x1234_5678_9ABC_DEF0, 0xFFFF_0000_0000_0001) for _ in range(120)]
    low = [0x1234_5678_0000_0000 | int(x) for x in [*rng.integers(0, 1 << 13, 90), *rng.integers(0, 1 << 30, 60)]]
    fps = np.unique(np.array([*near, *low, 0, (1 << 64) - 1], dtype=np.uint64))
    d = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = [(np.int64(r["a"]).view(np.uint64), np.int64(r["b"]).view(np.uint64)) for r in simhash.links(d, unit).collect()]
    want = _components(fps)
    up = {int(x): int(x) for x in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in found:
        assert want[int(a)] == want[int(b)]
        up[root(int(a))] = root(int(b))
    assert len({root(int(x)) for x in fps}) == len(set(want.values())) > 10


def test_near_dedup_of_repeated_and_null_ids(spark):
    """Rows that share an id but no text are documents of their own; a group of null ids, or with one, keeps one row."""
    a, b, c = ("first text about rivers and stones " * 9, "second words upon mountains with snow " * 9, "third lines over oceans far away " * 9)
    rows = [(1, a, "x"), (1, b, "x"), (2, a + " ", "x"), (None, b, "x"), (None, c, "x"), (None, c, "y"), (7, None, "x"), (8, "", "x"), (9, " ", "x"), (0, "lone words of its own kind here now", "x"), (0, "lone words of its own kind here now", "x")]
    out = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, th string"))
    assert out.columns == ["doc_id", "text", "th"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (None, c), (7, None), (0, rows[-1][1])], key=str)


def test_components_of_hot_nodes_and_chains(spark):
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000), (None, 3), (399, 2000), (2000, 2001)]
    from siltstone.llm.components import components

    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(400), 2000, 2001]} | {1000 + i: 1000 for i in range(61)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_brute_force(spark):
    rows = registry.queries()["op2_simhash"](spark, SF).collect()
    comp = _components(np.array([int(r["fingerprint"], 16) for r in rows], dtype=np.uint64))
    least = {}
    for r in rows:
        k = comp[int(r["fingerprint"], 16)]
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    assert all(r["component_id"] == least[comp[int(r["fingerprint"], 16)]] for r in rows)


def test_simhash_fingerprints_bit_by_bit(spark):
    """Each bit's majority, taken with the reference hash over words split by hand; ties, long, null, blank and non-ASCII texts, clashing columns."""
    import xxhash

    texts = [None, "", " \n\t", "One", "one  TWO", "a b c", "a b c a b c", "É é ß \u00a0x \x1c y", "A\x0bB\x0cC D", "w " * 30_000, "Zoë " + "many words here " * 50]
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(3, "One", 7, "x"), (None, "a b c", 7, "x")]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string"))
    assert got.columns == ["doc_id", "fp", "component_id"]
    want = []
    for i, t, *_ in rows:
        words, now = [], ""
        for ch in (t or "") + " ":
            if ch in " \t\n\x0b\x0c\r":
                words += [now] if now else []
                now = ""
            else:
                now += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
        shingles = [" ".join(words[j : j + 3]) for j in range(max(1, len(words) - 2))] if words else []
        bits = 0
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        for b in range(64):
            if 2 * sum(h >> b & 1 for h in hashes) > len(hashes):
                bits |= 1 << b
        want.append((i, bits))
    comp = _components(np.array([b for _, b in want], dtype=np.uint64))
    least = {}
    for i, b in want:
        if i is not None:
            least[comp[b]] = min(least.get(comp[b], i), i)
    key = lambda x: (x[0] is None, x)
    assert sorted(((r["doc_id"], int(np.int64(r["fp"]).view(np.uint64)), r["component_id"]) for r in got.collect()), key=key) == sorted(((i, b, least[comp[b]]) for i, b in want), key=key)


def test_mixing(spark):
    rows = registry.queries()["op3_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, registry.queries()["op3_mixing"](spark, SF).collect()))
    taken = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - t) <= 2 * mixing.BLOCK for (_, t), v in taken.items())
    assert mixing.targets([10, 100, 0], [1, 2, 3], 110) == [30.0, 80.0, 0.0]


def _mix_by_hand(rows, draws, plan):
    """Words taken of each document, block by block in plain Python, from the shards' draws."""
    from collections import Counter

    places, taken = {}, Counter()
    for k, off, size, rid in rows:
        for w in range(off, off + size):
            places.setdefault((k, w // mixing.BLOCK), Counter())[rid] += 1
    for _, k, start, n, blocks in draws:
        for j in range(start, start + n):
            turn = j // blocks
            with np.errstate(over="ignore"):
                key = np.uint64(mixing.SEED) + np.uint64(turn * 1_000_003 + k) * np.uint64(0x9E3779B97F4A7C15)
                b = int(mixing.permuted(np.array([j % blocks]), np.array([blocks]), np.array([key], dtype=np.uint64))[0])
            taken.update(places[k, b])
    return taken


def test_mixing_by_brute_force(spark):
    """Targets, draws and blocks against plain Python: many shards, nulls, repeated rows, one source of most rows, clashing columns."""
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 1, 5, 70, 300]))), rng.choice(["big"] * 6 + ["a", "tiny", None, "é"]), i, "x") for i in range(160)]
    rows += [(3, rows[3][1], rows[3][2], 0, "y"), (None, "no id here", "a", 0, "y"), (900, None, "a", 0, "y"), (901, " \t", "none", 0, "y"), (902, "word " * 9_000, "a", 1, "y")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int, k string")
    sizes = mixing.document_sizes(d)
    plan = mixing.source_plan(sizes)
    words = {}
    for _, t, s, *_ in rows:
        words[s] = words.get(s, 0) + len((t or "").split())
    order = sorted(words, key=lambda s: (s is None, s or ""))
    want = mixing.targets([words[s] for s in order], [1 + i % 3 for i in range(len(order))], sum(words.values()))
    assert plan["source"].tolist() == order and plan["source_size"].tolist() == [words[s] for s in order] and plan["target"].tolist() == want
    draws = sorted(map(tuple, mixing.shard_draws(spark, plan, 16).collect()))
    for k, slots in enumerate(plan["slots"]):  # each slot of a source once, in order of the shards
        mine = [(a, n) for _, x, a, n, _ in draws if x == k]
        assert [a for a, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))] and sum(n for _, n in mine) == slots
    per_shard = {}
    for s, _, _, n, _ in draws:
        per_shard[s] = per_shard.get(s, 0) + n
    assert max(per_shard.values()) <= 16 * len(order) and sum(per_shard.values()) == plan["slots"].sum()
    # shares of the drawn shards are near the sources' shares
    top = int(np.argmax(plan["slots"]))
    early = [n for s, x, _, n, _ in draws if x == top and s < len(per_shard) // 2]
    assert abs(sum(early) / (16 * (len(per_shard) // 2)) - plan["slots"][top] / plan["slots"].sum()) < 0.15
    got = sorted((r["doc_id"] or -1, r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.mix_counts(d).collect())
    place = [(r["k"], r["off"], r["size"], r["rid"]) for r in mixing.placed(sizes, plan).collect()]
    for k in range(len(order)):  # end to end, without a gap
        mine = sorted(x[1:3] for x in place if x[0] == k)
        assert [a for a, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
    hand = _mix_by_hand(place, map(tuple, mixing.shard_draws(spark, plan).collect()), plan)
    who = {r["rid"]: r for r in sizes.collect()}
    assert got == sorted((r["doc_id"] or -1, r["size"], words[r["source"]], want[order.index(r["source"])], hand[rid]) for rid, r in who.items())
    assert all(0 <= r[4] <= 3 * r[1] for r in got)


def test_mixing_with_more_sources_than_are_broadcast(spark, monkeypatch):
    d = spark.createDataFrame([(i, "word " * (i % 9), f"s{i % 7}" if i % 8 else None) for i in range(80)], "doc_id long, text string, source string")
    want = sorted(map(tuple, mixing.mix_counts(d).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(map(tuple, mixing.mix_counts(d).collect())) == want


@pytest.mark.parametrize("n", [1, 2, 5, 64, 999])
def test_permutation(n):
    assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 77)).tolist()) == list(range(n))


def test_bpe_forgets_without_changing_ids(monkeypatch):
    import tiktoken

    path, pattern = bpe._vocabulary()
    tok = bpe.Tokenizer(path, pattern)
    library = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=tok.ranks, special_tokens={})
    monkeypatch.setattr(bpe, "REMEMBERED", 12)
    rng = random.Random(7)
    words = ["the", "Zxqyvörld", "naïve!!", "%%%abc", "straßenbahnhaltestelle", "12345", "ß", "x" * 60] + ["".join(rng.choices("abcdeéß", k=rng.randint(1, 14))) for _ in range(300)]
    forgot = 0
    for k in range(60):
        texts = ["", None, *[" ".join(rng.choices(words[: 8 + 5 * k], k=rng.randint(1, 8))) for _ in range(3)], "the\nthe"]
        before = len(tok.units)
        ids, bounds = tok.encode(texts)
        back = tok.decode_runs(ids, bounds)
        forgot += len(tok.units) < before
        if k % 7 == 0:
            tok.keep(k % 3)  # as between tasks; 0 forgets all
            assert len(tok.units) == len(tok.seen) == len(tok.starts) - 1 <= k % 3
        for i, t in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode_ordinary(t or "")
            assert back[i] == (t or "").encode()
    assert forgot > 5


def test_bpe_long_pieces(monkeypatch):
    """Pieces of any length against the library: repeats, overlaps, loose tokens, and every length around the border."""
    import tiktoken

    path, pattern = bpe._vocabulary()
    tok = bpe.Tokenizer(path, pattern)
    lib = tiktoken.Encoding("long", pat_str=pattern, mergeable_ranks=tok.ranks, special_tokens={})
    rng = random.Random(5)
    loose = [t for t, in tok.con.sql("SELECT tok FROM loose").fetchall()]
    by_rank = {r: b for b, r in tok.ranks.items()}
    letters = [by_rank[r].decode("utf-8", "ignore") for r in rng.sample(loose, min(300, len(loose)))]
    letters = [x for x in letters if x.isalpha()]
    pieces = ["a" * n for n in (62, 63, 64, 65, 99, 100, 1001, 5000)] + ["ab" * 333, "日本語テキスト" * 120, "é" * 201, "-" * 70, "=" * 129 + "-" * 64, " " * 300, "xyz" * 2500]
    pieces += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(60, 400))) for _ in range(60)]
    pieces += ["".join(rng.choices("ab", k=rng.randint(60, 300))) for _ in range(40)]
    pieces += ["".join(rng.choices(letters, k=30)) for _ in range(60) if letters]
    pieces += [chr(rng.randint(0x4E00, 0x9000)) * 2 + "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(400)) for _ in range(3)]
    ids, bounds = tok.encode(pieces)
    for i, p in enumerate(pieces):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == lib.encode_ordinary(p), p
    assert tok.decode_runs(ids, bounds) == [p.encode() for p in pieces]
    monkeypatch.setattr(bpe, "LONG_PIECE", 1)  # the same recursion for all
    short = bpe.Tokenizer(path, pattern)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 30))) for _ in range(400)]
    ids, bounds = short.encode(words)
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(words))] == [lib.encode_ordinary(w) for w in words]


def test_bpe_round_trip_and_library(spark):
    import tiktoken

    path, pattern = bpe._vocabulary()
    tok = bpe.tokenizer(path, pattern)
    lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=tok.ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in bpe.encode(docs.select("doc_id", "text")).collect():
        want = lib.encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for t in ["", "a  b", " x", "x ", "a \tb\n\n c", "日本語 テキスト", "aaaa" * 40, "it's I'LL", "\x1c a\x85b\x00", "é" * 99]:
        ids, bounds = tok.encode([t])
        assert ids.tolist() == lib.encode_ordinary(t) and tok.decode_runs(ids, bounds) == tok.decode([ids.tolist()]) == [t.encode()]


@pytest.mark.parametrize(("query", "column", "recall", "precision"), [("op6_quality_classifier", "quality", 0.98, 0.98), ("op9_toxicity", "toxic", 0.9, 0.9)])
def test_held_out_recall_and_precision(spark, query, column, recall, precision):
    """Of either class: to answer one class for every document fails."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", column)
    rows = registry.queries()[query](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r[column] for r in rows]), np.array([r["predicted"] for r in rows])
    assert p[y == 1].mean() >= recall and y[p == 1].mean() >= precision and (p[y == 0] == 0).mean() >= 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_nnpu_risk_and_gradient():
    """The risk against the formula term by term, its gradient against differences, on both sides of zero."""
    rng = np.random.default_rng(8)
    pos, unl = [[np.sort(rng.choice(12, rng.integers(0, 6), replace=False)) for _ in range(n)] for n in (9, 15)]

    def outputs(w, sets):
        return np.array([sum(w[k] for k in s) + w[-1] for s in sets])

    def estimate(w, prior):
        plus = sum(np.log(1 + np.exp(-f)) for f in outputs(w, pos)) / len(pos)
        as_negative = sum(np.log(1 + np.exp(f)) for f in outputs(w, pos)) / len(pos)
        minus = sum(np.log(1 + np.exp(f)) for f in outputs(w, unl)) / len(unl)
        return prior * plus, minus - prior * as_negative

    signs = set()
    for prior, scale in ((0.1, 1.0), (0.5, 3.0), (0.9, 3.0)):
        for _ in range(6):
            w = rng.standard_normal(13) * scale
            want = estimate(w, prior)
            assert toxicity.risk(outputs(w, pos), outputs(w, unl), prior) == pytest.approx(want)
            signs.add(want[1] < 0)
            g = toxicity.gradient(w, (*toxicity._rows(pos), len(pos)), (*toxicity._rows(unl), len(unl)), prior)
            for k in range(13):
                d = np.zeros(13)
                d[k] = 1e-6
                side = (lambda v: sum(estimate(v, prior))) if want[1] >= 0 else (lambda v: -estimate(v, prior)[1])
                assert g[k] == pytest.approx((side(w + d) - side(w - d)) / 2e-6, abs=1e-5)
    assert signs == {True, False}


def test_toxicity_learns_without_negatives(spark):
    """Labels 0 are not read but for the prior: other documents with them give the same model."""
    rng = random.Random(6)
    filler = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(filler, k=40)) + (" vilest vilest" if i % 9 == 0 else "")) for i in range(900)]
    docs = spark.createDataFrame([*rows, (None, "no id"), (5, rows[5][1]), (9, None)], "doc_id long, text string")
    first = spark.createDataFrame([(i, 0, int(i % 9 == 0)) for i in range(0, 900, 2)] + [(9, 0, None), (None, 0, 1)], LABELS)
    other = spark.createDataFrame([(i, 0, 1) for i in range(0, 900, 18)] + [(i, 0, 0) for i in range(1, 900, 2) if i % 9], LABELS)
    models = [toxicity.learn(docs, x) for x in (first, other)]
    assert models[0].rows == models[1].rows and "vilest$" in models[0].rows
    got = toxicity.score(docs, models[0]).collect()
    assert len(got) == 903 and all((r["score"] >= 0.3) == (r["doc_id"] is not None and r["doc_id"] % 9 == 0) for r in got if r["doc_id"] != 9)
    none = toxicity.learn(docs, spark.createDataFrame([(1, 0, 0)], LABELS))
    assert not none.rows and none.score(["vilest"], {})[0] == pytest.approx(0.005)


def test_quality_score_by_compression(spark):
    """Scores against sizes taken one by one, and the calibration against a direct logistic fit at the labels' prior."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "long " * 60_000)], docs.schema))
    model = quality_classifier.learn(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert model.good and model.bad
    for r in quality_classifier.score(docs, model).collect():
        raw, sums = (r["text"] or "").encode(), []
        pieces = [raw[i : i + 4096] for i in range(0, len(raw), 4096)] or [b""]
        for d in (model.good, model.bad):
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=3)
            sums.append(sum(len(c.compress(p)) for p in pieces))
        size = len(raw) + 16 * len(pieces)
        x = (sums[1] - sums[0]) / size, (sums[1] - sums[0]) / sum(sums), min(sums) / size
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(np.dot(x, model.weights[:3]) + model.weights[3], -30, 30))))


def test_quality_calibration_moves_to_the_prior():
    sample = [("the cat sat on a mat and " * 8 + str(i), 1) for i in range(60)] + [("zz## qq%% 77 " * 12 + str(i), 0) for i in range(60)]
    even, shifted = quality_classifier.fit(sample, 0.5), quality_classifier.fit(sample, 0.9)
    held = [y for i, (_, y) in enumerate(sample) if i % 3 == 0]
    assert np.mean(held) == 0.5 and shifted.weights[3] - even.weights[3] == pytest.approx(np.log(9)) and (shifted.weights[:3] == even.weights[:3]).all()


def test_samples_are_bounded_and_whole(spark):
    from siltstone.llm.common import crc_mod
    from siltstone.llm.sampling import labelled_sample, text_sample

    text = {i: f"text {i} " + "x" * (50_000 if i == 7 else 3) for i in range(3000)}
    docs = spark.createDataFrame([(i, t) for i, t in text.items()] * 2 + [(4, None), (None, "null id")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0), 0) for i in range(3000)] * 2 + [(None, 1, 1), (11, 1, 0), (13, None, 0)], LABELS)
    got, prior = labelled_sample(docs, labels, "quality", crc_mod(F.col("doc_id"), 5) != 0, 100)
    import zlib

    may = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5]
    assert [sum(y for _, y in got), len(got)] == [100, 200] and prior == pytest.approx(np.mean([i % 10 == 0 or i == 11 for i in may]))
    for t, y in got:
        i = int(t.split()[1]) if t else 4
        assert i in may and y == int(i % 10 == 0 or i == 11) and t == (text[i] if i != 4 else "")
    assert len(labelled_sample(docs, labels, "quality", F.lit(True), 10_000)[0]) == 3000
    assert labelled_sample(docs, labels.limit(0), "quality", F.lit(True), 10) == ([], 0.0)
    some = text_sample(docs, crc_mod(F.col("doc_id"), 4) != 2, 50)
    assert len(some) == len(set(some)) == 50 and text_sample(docs.limit(0), F.lit(True), 5) == []


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = registry.queries()["op8_langid"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98


def test_language_model_keeps_every_ngram(spark, monkeypatch):
    from collections import Counter

    rng = np.random.default_rng(2)
    texts = {"zh": ["".join(map(chr, rng.integers(0x4E00, 0x9000, 330_000)))], "en": ["the cat sat on the mat", "a cat and the hat"]}
    by = {}
    for lang, own in texts.items():
        c = langid.symbols(own)[0].tolist()
        n = {4: Counter(tuple(c[i - 3 : i + 1]) for i in range(3, len(c)) if c[i] != langid.START)}
        for k in (3, 2, 1):
            n[k] = Counter(g[1:] for g in n[k + 1])
        total, kinds = Counter(), Counter()
        for k in n:
            for g, m in n[k].items():
                total[g[:-1]] += m
                kinds[g[:-1]] += 1
        by[lang] = n, total, kinds
    base = 1 / (max(len(n[1]) for n, _, _ in by.values()) + 257)

    def p(lang, g):
        n, total, kinds = by[lang]
        low = p(lang, g[1:]) if len(g) > 1 else base
        t = total[g[:-1]]
        return max(n[len(g)][g] - langid.DISCOUNT, 0) / t + langid.DISCOUNT * kinds[g[:-1]] / t * low if t else low

    d = spark.createDataFrame([(i, lang, t) for lang, own in texts.items() for i, t in enumerate(own)], "doc_id long, lang string, text string")
    asked = [texts["zh"][0][:60], texts["zh"][0][-60:], "the hat sat", "日本ö xx", None, "", texts["zh"][0][50:20_000:777]]
    found = []
    for most in (1 << 27, 1 << 21):  # one shard; several
        monkeypatch.setattr(langid, "SHARD_BYTES", most)
        model = langid.learn(d)
        shards = [x.value for x in model.shards]
        assert (len(shards) > 3) == (most < 1 << 27) and sum(len(x.keys[3]) for x in shards) >= len(by["zh"][0][4].keys() | by["en"][0][4].keys()) > 320_000
        e, n = model.entropies(asked)
        assert n.tolist()[2:6] == [9, 5, 0, 0]
        found.append(e)
        for t, mine in zip(asked, e, strict=True):
            c = langid.symbols([t])[0].tolist()
            for lang, got in zip(model.langs, mine, strict=True):
                assert got == pytest.approx(-np.mean([np.log(p(lang, tuple(c[i - 3 : i + 1]))) for i in range(3, len(c))]) if t else 0, rel=1e-4)
        got = langid.predict(spark.createDataFrame([(i, t, "x") for i, t in enumerate(asked)], "i int, text string, score string"), model).orderBy("i").collect()
        assert [r["lang_pred"] for r in got] == ["zh", "zh", "en", got[3]["lang_pred"], "und", "und", "zh"] and got[0].asDict().keys() == {"i", "lang_pred", "score", "entropy", "rejected"}
        assert [r["entropy"] for r in got] == pytest.approx([x.min() for x in e])
    assert found[0] == pytest.approx(found[1])


def test_language_calibration():
    """Texts of two languages at known entropies: the threshold lies above them, and a lead counts more the cleaner they part."""
    rng = np.random.default_rng(1)
    lang = np.repeat([0, 1], 300)
    sharp = []
    for lead in (1.0, 0.05):
        own = 2 + 0.05 * rng.standard_normal(600) + lang
        nats = np.where(np.arange(2) == lang[:, None], own[:, None], own[:, None] + lead + 0.1 * rng.standard_normal((600, 1)))
        m = langid.Model(["a", "b"], [], np.full(2, np.inf))
        langid._calibrated(m, nats, np.full(600, 9), lang)
        assert ((own > m.reject[lang]).mean() <= 0.01) and (m.reject < [2.5, 3.5]).all()
        sharp.append(m.sharp)
        # the stated share of the right language is about its frequency
        share = 1 / np.exp(-m.sharp * (nats - nats.min(axis=1, keepdims=True))).sum(axis=1)
        assert share.mean() == pytest.approx((nats.argmin(axis=1) == lang).mean(), abs=0.06)
    assert sharp[0] > 5 and sharp[1] > 1


def test_language_never_learnt_is_rejected(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    foreign = ["Съешь ещё этих мягких французских булок, да выпей чаю.", "いろはにほへと ちりぬるを わかよたれそ つねならむ"]
    docs.unionByName(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(foreign)], docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r["rejected"] for r in registry.queries()["op8_langid"](spark, str(tmp_path)).collect()}
    assert rows[-1] and rows[-2]
    assert np.mean([x for i, x in rows.items() if i >= 0]) < 0.1


def test_chat_escapes_and_order(spark):
    d = spark.createDataFrame([(1, 0, "user", chat.PROBE), (1, 1, "assistant", "<#\\ </turn>\n"), (2, 0, "assistant", None), (None, None, None, ""), (3, 0, "us:er", "x")], "conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in chat.read_back(chat.chat_segments(d)).collect()}
    assert rows[1]["valid"] and not rows[2]["valid"] and rows[1]["loss_chars"] == len("<#\\ </turn>\n")
    assert rows[3]["turns_sha256"] == hashlib.sha256(b"us:er\nx\n").hexdigest()


def test_chat_odd_rows(spark):
    """Empty table, extra and clashing columns, equal and null turns, texts that look like markers, against hashes taken by hand."""
    schema = "conv_id long, turn long, role string, text string, seq string, valid int"
    rows = [(1, 1, "assistant", "b </turn>\n### user: x </turn>\n", "q", 1), (1, 0, "user", "a", "q", 1), (1, 1, "assistant", "a </turn>", "q", 1), (2, None, "system", "\\", "q", 1), (2, 5, None, None, "q", 1), (3, 0, "user", "", "q", 1), (3, 0, "user", "", "q", 1), (None, 0, "user", "n", "q", 1)]
    assert chat.read_back(chat.chat_segments(spark.createDataFrame([], schema))).count() == 0
    d = spark.createDataFrame(rows, schema)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    want = {}
    for c, _, role, text, *_ in order:
        want.setdefault(c, []).append((role or "", text or ""))
    segments = chat.chat_segments(d)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    for c, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        text = "".join(r["text"] for r in sorted((r for r in segments.collect() if r["conv_id"] == c), key=lambda r: (r["seq"], r["part"])))
        at, read = 0, []
        while at < len(text):
            role, t, at = chat.TEMPLATE.parse(text, at)
            read.append((role, t))
        assert read == turns and got[c]["formatted_chars"] == len(text)
    assert got[None]["valid"] and not got[1]["valid"] and not got[2]["valid"] and not got[3]["valid"]
    for broken in (segments.orderBy("conv_id", F.desc("seq"), "part"), segments.where("part <> 2")):
        with pytest.raises(Exception, match="out of place|open turn"):
            chat.read_back(broken.coalesce(1)).collect()


def test_topk_ties_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, []), (7, [0.5])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(d, d.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1, 65536), (2, 2, 65536), (3, 7, 32768), (4, 6, 0)]
    assert topk.top_k(d.limit(0), d.limit(0)).count() == 0


@pytest.mark.parametrize("sigma", [0.0, 0.3, 1.0, 2.0])
def test_topk_brute_force_over_length_spreads(spark, tmp_path, monkeypatch, sigma):
    """Several files, lengths spread by a log-normal, groups of copies, negative products, more blocks than one, extra columns."""
    monkeypatch.setattr(topk, "BUCKET_BYTES", 2048)
    rng = np.random.default_rng(11)
    v = rng.standard_normal((3000, 8))
    v *= np.exp(sigma * rng.standard_normal(3000))[:, None] / (np.linalg.norm(v, axis=1)[:, None] if not sigma else 1)
    v[rng.integers(0, 3000, 600)] = v[np.argsort(-np.linalg.norm(v, axis=1))[rng.integers(0, 30, 600)]]
    v[:40] = -np.abs(v[:40])
    d = spark.createDataFrame([(int(i), x.tolist(), 0, "x") for i, x in zip(rng.permutation(3000), v, strict=True)], "vec_id long, embedding array<double>, score int, block string")
    d.repartition(7).write.parquet(f"{tmp_path}/v")
    d = spark.read.parquet(f"{tmp_path}/v")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 9)
        spark.conf.set("spark.sql.files.openCostInBytes", 1 << 20)
        got = {}
        for r in topk.top_k(d, d.where("vec_id % 20 = 0"), query_block=40).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    finally:
        for k, x in kept.items():
            spark.conf.set(k, x)
    at = {r["vec_id"]: np.floor(np.array(r["embedding"]) * 256).astype(np.int64) for r in d.collect()}
    ids = np.array(sorted(at))
    every = np.stack([at[i] for i in ids.tolist()])
    for q in range(0, 3000, 20):
        s = every @ at[q]
        best = [j for j in np.lexsort((ids, -s)) if ids[j] != q][: topk.K]
        assert got[q] == [(int(ids[j]), int(s[j])) for j in best]


def _sorted(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=repr)


def test_odd_rows(spark, odd, empty):
    """Each operator over nulls, blanks, repeated rows, a null id, a long text and columns named like its own: values, and what becomes of those columns."""
    import tiktoken

    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(10)] + [(None, 1, 1), (3, None, None)], LABELS)
    ids = [r[0] for r in ODD]
    lib = tiktoken.Encoding("odd", pat_str=bpe._vocabulary()[1], mergeable_ranks=bpe.tokenizer(*bpe._vocabulary()).ranks, special_tokens={})

    rules = quality_rules.quality_rules(odd)
    assert _sorted(rules.collect(), "doc_id", "n_words") == sorted(((r[0], len((r[1] or "").split())) for r in ODD), key=repr)
    encoded = bpe.encode(odd).collect()  # ids is replaced, the others stay
    assert _sorted(encoded, "doc_id", "ids", "kept", "score") == sorted(((r[0], lib.encode_ordinary(r[1] or ""), r[5], r[6]) for r in ODD), key=repr)
    for scored in (quality_classifier.score(odd, quality_classifier.learn(odd, labels)), toxicity.score(odd, toxicity.learn(odd, labels))):
        got = scored.collect()  # score is replaced, the others stay
        assert _sorted(got, "doc_id", "kept", "ids", "lang") == sorted(((r[0], r[5], r[7], r[2]) for r in ODD), key=repr)
        assert all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got if r["doc_id"] == 4}) == 1
        assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1  # null and empty alike
    told = langid.predict(odd, langid.learn(odd)).collect()
    assert _sorted(told, "doc_id", "kept", "ids") == sorted(((r[0], r[5], r[7]) for r in ODD), key=repr)
    by = {r["doc_id"]: r for r in told}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (1, 2, 3)) and by[9]["lang_pred"] != "und"
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 9]
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and {r["doc_id"] for r in mixed.collect()} <= {4, 9, None}
    none_model = quality_classifier.fit([])
    assert langid.learn(empty) is None and _sorted(langid.predict(odd, None).collect(), "doc_id", "lang_pred") == sorted(((i, "und") for i in ids), key=repr)
    for out in (quality_rules.quality_rules(empty), simhash.simhash_groups(empty), simhash.near_dedup(empty), mixing.mix_counts(empty), mixing.mix(empty), bpe.encode(empty), line_dedup.line_dedup(empty), quality_classifier.score(empty, none_model), toxicity.score(empty, toxicity.learn(empty, labels)), langid.predict(empty, None)):
        assert out.count() == 0


def test_lines_in_batches(spark):
    line = "A line of text that many documents share, word for word."
    d = spark.createDataFrame([(i, f"  {line.upper() if i % 2 else line}\nown {i}\n{line}") for i in range(6)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup.line_dedup(d).collect()}
    assert all(rows[i]["n_dropped"] == 2 and rows[i]["kept"] == f"own {i}" for i in range(5)) and rows[5]["n_dropped"] == 0


def test_line_runs_hold_each_line_once(spark):
    """Batches that share lines: what the anti-joins leave is each line's first batch; counts follow over compactions."""
    from collections import Counter

    rng = random.Random(4)
    runs, n, last, first = line_dedup.LineRuns(spark, 3), Counter(), {}, {}
    schema = "doc long, h1 long, h2 long"
    for k in range(6):
        rows = sorted({(100 * k + rng.randrange(20), rng.randrange(12 + 3 * k), 7) for _ in range(60)})
        batch = spark.createDataFrame(rows, schema)
        new = {(r["h1"], r["h2"]) for r in runs.unseen(batch).collect()}
        assert new == {r[1:] for r in rows} - n.keys()
        runs.add(batch)
        for doc, *h in rows:
            n[tuple(h)] += 1
            last[tuple(h)] = max(last.get(tuple(h), doc), doc)
            first.setdefault(tuple(h), k)
        held = [(r["h1"], r["h2"]) for name in runs.runs() for r in spark.table(name).collect()]
        assert len(held) == len(set(held)) == len(n)
    assert len(runs.runs()) == 2  # six batches: 4 + 2
    assert {(r["h1"], r["h2"]): (r["n_docs"], r["last_doc"]) for r in runs.totals().collect()} == {h: (n[h], last[h]) for h in n}
    plan = runs.unseen(spark.table(runs.runs()[0]))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    runs.close()
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("line_run")]


def test_lines_by_brute_force(spark):
    """Lines of all kinds of frequency, one of them in most documents; nulls, repeated rows, long texts and clashing columns."""
    rng = random.Random(9)
    pool = [f"{'Shared ' * 5}line number {i} of the pool" for i in range(40)]
    rows = [(i, "\n".join([rng.choice(["", " \t", "short", pool[0], pool[0].upper() + " \r", *rng.choices(pool, k=2), f"{'own ' * 12}{i}"]) for _ in range(rng.randrange(12))]), "k", 5, i) for i in range(300)]
    rows += [(300, None, "k", 1, 0), (301, "", "k", 1, 0), (5, rows[5][1], "z", 2, 0), (302, "\n".join(pool * 500), "k", 1, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_lines long, h1 int").repartition(5)
    docs, top = {}, {}
    for i, (doc, t, *_) in enumerate(rows):
        for x in (t or "").split("\n"):
            k = line_dedup.line_key(x)
            if len(k) >= 40:
                docs.setdefault(k, set()).add(i)
                top[k] = max(top.get(k, doc), doc)
    want = []
    for doc, t, *_, h in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(docs.get(line_dedup.line_key(x), ())) >= 5 and doc < top[line_dedup.line_key(x)])]
        want.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept), h))
    out = line_dedup.line_dedup(d)
    assert sorted(out.columns) == ["doc_id", "h1", "kept", "n_dropped", "n_lines"]
    assert sorted((r["doc_id"], r["kept"], r["n_lines"], r["n_dropped"], r["h1"]) for r in out.collect()) == sorted(want)
    assert sum(w[3] for w in want) > 300


def test_pipeline_stages_by_brute_force(spark):
    import corpus_pipeline as p
    from siltstone.llm.common import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = materialize(p.quality(spark, docs, SF), "test")
    assert 0 < good.count() < docs.count()
    cut = materialize(p.lines(spark, good, SF), "test")
    assert cut.count() == good.count() and all(set(r["text"].split("\n")) <= set((whole[r["doc_id"]] or "").split("\n")) | {""} for r in cut.collect())
    one = materialize(p.near_duplicates(spark, cut, SF), "test")
    fps = _components(np.array([simhash.fingerprint(r["text"]) for r in cut.collect()], dtype=np.uint64))
    assert one.count() == len(set(fps.values()))
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    mixed = materialize(p.mixture(spark, one, SF), "test")
    assert all(part in texts[r["doc_id"]] for r in mixed.collect() for part in [r["text"].split("\n")[0]])
    total = mixing.mix_counts(one).agg(F.sum("taken")).first()[0]
    assert sum(len(r["text"].split()) for r in mixed.collect()) == total
    out = p.tokens(spark, mixed, SF)
    assert out.count() == mixed.count()


def test_pipeline_over_odd_tables(spark, tmp_path):
    """run() over nulls in every column, empty and long texts, repeated rows and ids, extra columns; and over no rows at all."""
    import corpus_pipeline as p
    from siltstone.llm.common import materialize, written

    good = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").where("length(text) BETWEEN 500 AND 3000").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "en", f"s{i % 3}", len(t), "x", 1.0) for i, t in enumerate(good)]
    rows += [(100, None, None, None, None, None, None), (101, "", "en", "s0", 0, "x", 0.0), (None, good[0] + " tail", None, "s1", 5, "x", 0.0), (3, good[3], "en", "s0", 9, "y", 2.0), (4, good[5] + " other words", "en", None, 9, "y", 2.0), (102, (good[7] + " ") * 60, "en", "s2", 9, "y", 2.0)]
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels.where("quality = 0"), "doc_id").limit(30).collect()
    bad = [(1000 + i, r["text"], "en", "s0", 1, "x", 0.0) for i, r in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, th double"
    spark.createDataFrame(rows + bad, schema).write.parquet(f"{tmp_path}/odd/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(1000 + i, 0, 0) for i in range(len(bad))] + [(None, 1, None), (7, None, None)], LABELS).write.parquet(f"{tmp_path}/odd/labels.parquet")
    mine = materialize(spark.range(3).toDF("x"), "other")
    held = written(spark)
    out = p.run(spark, f"{tmp_path}/odd")
    assert len(written(spark) - held) == 1 and mine.count() == 3  # the last stage's input is left, and what was there before
    assert out.columns[:3] == ["doc_id", "lang", "source"] and {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    got = out.collect()
    kept = {r["doc_id"] for r in got}
    assert len(kept & set(range(40))) > 25 and len(kept & set(range(1000, 1100))) < len(bad) / 3
    tok = bpe.tokenizer(*bpe._vocabulary())
    for r in got:  # the ids are those of the decoded text
        text = tok.decode([r["ids"]])[0]
        assert hashlib.sha256(text).hexdigest() == r["decoded_sha256"] and text and len(r["ids"]) == r["n_tokens"]
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/odd/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert p.run(spark, f"{tmp_path}/none").count() == 0
