import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.functions import markup, sections, text
from siltstone.operators import entity, quality, store
from siltstone.plans import registry
from siltstone.sinks import files as sinks
from siltstone.sources import files as sources

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_oracle(spark, against, name):
    against(registry.queries()[name](spark, SF), registry.oracle_sql()[name], SF)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_saving_is_idempotent(spark):
    rows = spark.createDataFrame([(1, "a", "x", None, 10, 1, None, 5), (2, None, None, "c", 20, 1, 3, 4)], "k int, t string, f string, c string, h int, seen int, low int, high int")
    again = store.save_postings(rows, rows, "k", "h", "seen", ["t"], ["f"], ["c"], "low", "high")
    assert {(r["change"], r["pay_history"]) for r in again.collect()} == {("unchanged", False)}
    assert sorted(tuple(r)[:1] for r in store.save_postings(rows.limit(0), rows, "k", "h", "seen", ["t"], ["f"], ["c"], "low", "high").where("change = 'inserted' AND pay_history").collect()) == [(1,), (2,)]


def test_pairs_by_key_lose_no_link(spark):
    rows = [(1, "acme tools"), (2, "acme tools"), (3, "acme toolz"), (4, None), (5, "..."), (6, "other"), (7, "acme tools")]
    got = {(r["a"], r["b"]): r["similarity"] for r in entity.trigram_pairs(spark.createDataFrame(rows, "k long, n string"), "k", "n").collect()}
    assert set(got) == {(1, 2), (1, 7), (1, 3)} and got[1, 2] == 1.0 and 0.5 <= got[1, 3] < 1


def test_guard_and_push_refuse(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    assert store.guarded(a, [a, a.limit(1)], ["k"], ["k", "v"]) is a
    for bad in (a.limit(1), a.unionByName(a), a.drop("v"), a.withColumn("rn", F.lit(1))):
        with pytest.raises(ValueError):
            store.guarded(bad, [a], ["k"], ["k", "v"])
    here = spark.createDataFrame([(1, "a", "s", 1, 1, 9)], "id long, code string, s string, f int, l int, duplicate_of long")
    with pytest.raises(Exception, match="outside the push"):
        store.push(here, here.limit(0), ["code"], ["s"], "f", "l").collect()
    known = spark.createDataFrame([(1, "EUR")], "id long, value string")
    with pytest.raises(Exception, match="no value for cur"):
        store.translated(spark.createDataFrame([(2,)], "cur long"), known, known, "cur").collect()
    got = store.translated(spark.createDataFrame([(1,), (None,)], "cur long"), known, known.withColumn("id", F.lit(7).cast("long")), "cur").collect()
    assert sorted((r[0] for r in got), key=str) == [7, None]


def test_readers_refuse_and_retry(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t")
    assert sources.row_count(spark, [f"{tmp_path}/t"]) == 5
    with pytest.raises(Exception, match="none|exist"):
        sources.row_count(spark, [f"{tmp_path}/none"])
    with pytest.raises(ValueError):
        sources.row_count(spark, [])
    tried = []

    def fails():
        tried.append(1)
        raise sources.Permanent("gone")

    with pytest.raises(sources.Permanent):
        sources.retried(fails, 5, 0.0)
    assert len(tried) == 1 and list(sources.delays(7, 3, 90)) == [3, 6, 12, 24, 48, 90]
    with pytest.raises(ValueError):
        sinks.load_order({"a": {"b"}, "b": {"a"}})
    assert sinks.read_state(spark, f"{tmp_path}/no.json") == {}
    for k in range(2):
        sinks.write_state(spark, f"{tmp_path}/s.json", {"k": k})
    assert sinks.read_state(spark, f"{tmp_path}/s.json") == {"k": 1}


def test_sections_and_pages_of_odd_texts():
    v = sections.Vocabulary()
    assert sections.sections_of(None, v) == sections.sections_of("", v) == (None,) * 5 + (0, [])
    many = "Requirements: " + " • ".join(f"item {i} {'x' * 700}" for i in range(60))
    got = sections.sections_of(many, v)[0].split("\n")
    assert len(got) <= 40 and all(len(x) <= 602 for x in got)
    assert text.chunks_of("", 5) == [] and "".join(text.chunks_of("abcdefghijk", 4)) == "abcdefghijk"
    assert text.repaired("Ã©") == "é" and text.repaired("é ñ") == "é ñ" and text.fold_text("Mô TẢ\u200c") == "mota"
    assert [(ord(a), ord(b)) for _, a, b in text.SCRIPTS] == [(0x3040, 0x30FF), (0x1100, 0x11FF), (0xAC00, 0xD7AF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x0530, 0x058F), (0xFB13, 0xFB17), (0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F), (0x1200, 0x137F), (0x1000, 0x109F), (0x1780, 0x17FF), (0x0E80, 0x0EFF), (0x0D80, 0x0DFF)]
    page = markup.tree("<p>a<br>b<div><span>Label</span></div><div>value <script>x</script></div></p><unclosed>")
    assert markup.labelled(page, " label: ") == "value" and markup.labelled(page, "") is None and markup.posting_of(page) is None
    assert markup.pick_title(markup.tree("<title>Site | Cook wanted | site</title>"), None, "www.site.test") == ("Cook wanted", "title-tag")
    assert markup.pick_title(markup.tree(""), "http://x/ab") == (None, None) and markup.pick_title(markup.tree("<h1>0 €</h1>"), None, "", "Hint here") == ("Hint here", "listing")
    assert markup.charset(b'<meta charset="windows-1252">', "text/html; charset=") == "windows-1252" and markup.charset("é".encode("latin-1"), None) == "iso-8859-1"


def test_reasons_in_order(spark):
    rows = [(None, "t", "d" * 90), ("https://x.test/", "t", ""), ("https://x.test/job/7", "", "d" * 90), ("https://x.test/job/7", "Jobs.", "d" * 90), ("https://x.test/job/7", "ab", "d" * 90), ("https://x.test/job/7", "Cook", "d" * 79), ("https://x.test/job/7", "Cook", "d" * 80), ("https://a.x.test/job/7", "Cook jobs", "d" * 80), ("https://y.test/job/7", "Cook", "d" * 80)]
    d = spark.createDataFrame(rows, "u string, t string, d string").coalesce(1)
    got = [r[0] for r in d.select(quality.reject_reason(F.col("u"), F.col("t"), F.col("d"), F.lit("x.test"))).collect()]
    assert got == ["no url", "site root, not a posting", "no title", "navigation title", "title too short", "no job description (79 chars)", None, "category title", "offsite link (y.test)"]


def test_suffixes(spark):
    d = spark.createDataFrame([("Acme Group Ltd.",), ("Inc",), ("Zegogo Corporation",)], "n string")
    assert [r[0] for r in d.select(entity.without_suffix(F.col("n"))).collect()] == ["Acme", "Inc", "Zegogo"]


@pytest.fixture(scope="module")
def cut_pages(tmp_path_factory):
    """Pages whose heading and title end within a reference, a page without text and one that is null."""
    folder = tmp_path_factory.mktemp("cut")
    ends = [whole[:k] for whole in ("&amp;", "&quot;", "&lt;", "&#x27;", "&nbsp;", "&copy;") for k in range(1, len(whole) + 1)] + ["R&D", "&amp;amp", "&ampx", "&amp;lt;"]
    pages = [f"<html><head><title>Site of{e}</title><script>a&&b&amp</script></head><body><h1>Cook wanted{e}</h1><p>a &amp; b{e}<a href='/x?a&amp=1'>c</a></p></body></html>" for e in ends for _ in range(2)] + ["", None]
    pd.DataFrame({"page_id": range(1, len(pages) + 1), "html": pages}).to_parquet(folder / "pages.parquet")
    return str(folder)


def test_cleaning_of_cut_references(spark, against, cut_pages):
    against(registry.queries()["fn_clean_html"](spark, cut_pages), registry.oracle_sql()["fn_clean_html"], cut_pages)
    assert text.html_text("<b>a &amp</b>") == "a &" and text.html_text("<b>a &amp</b>", closed=True) == "a &amp"
    assert text.html_text("R&D &eacute; &#233; &#xE9; &#233 &notit; \ufdd0 &#xFDD1;<b>&lt &", closed=True) == "R&D é é é &#233 &notit; \ufdd0 &lt &"


def test_titles_of_cut_references(spark, against, cut_pages):
    against(registry.queries()["fn_title_pick"](spark, cut_pages), registry.oracle_sql()["fn_title_pick"], cut_pages)
    page = '<meta property="og:title" content="R&D cook &amp"><title>cook &amp</title><script>a &amp; b && c</script>'
    assert markup.pick_title(markup.tree(page)) == ("R&D cook &", "og:title") and markup.pick_title(markup.tree(page, closed=True)) == ("R&D cook &amp", "og:title")
    assert [n.own_text() for n in markup.tree(page, closed=True).walk() if n.name == "script"] == ["a &amp; b && c"]
