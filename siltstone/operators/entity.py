"""Entity resolution: cross-source duplicates, trigram pairs, and the upsert's states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Corporate suffix words.
SUFFIX_WORDS = ("incorporated", "corporation", "corp", "llc", "ltd", "limited", "company", "group", "holdings", "enterprises", "industries", "plc", "gmbh", "llp", "lp", "inc", "co")


def normalized(text: Column) -> Column:
    """Lower case, without . , - _ / \\ ' " ( ) &, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[.,\-_/\\'\"()&]", ""), r"[ \t\n\r\f]+", " "))


def without_suffix(name: Column) -> Column:
    """name without its trailing corporate words; the name itself if nothing is left."""
    cut = F.trim(F.regexp_replace(name, rf"(?i)(?:\s+(?:{'|'.join(SUFFIX_WORDS)})\.?)+$", ""))
    return F.coalesce(F.nullif(cut, F.lit("")), name)


def trigrams(text: Column) -> Column:
    """The set of 3-grams of the words, each with two blanks before and one behind."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """The share of all 3-grams of two texts that both hold; null where neither has one."""
    x, y = trigrams(a), trigrams(b)
    both = F.size(F.array_intersect(x, y))
    return F.try_divide(both.cast("double"), (F.size(x) + F.size(y) - both).cast("double"))


def trigram_name_pairs(names: DataFrame, name: str, threshold: float = 0.5) -> DataFrame:
    """(n1, n2, similarity), n1 < n2, of different names at or above the threshold.

    A pair must share a gram of its prefix: of a set of n grams in order of
    rarity, one of the first n - ceil(threshold * n) + 1. Only these are
    exploded and joined; the similarity is then taken from whole sets.
    """
    sets = names.select(F.col(name).alias("n")).where("n IS NOT NULL").distinct().select("n", trigrams(F.col("n")).alias("g")).where(F.size("g") > 0)
    rare = sets.select(F.explode("g").alias("t")).groupBy("t").agg(F.count("*").alias("c"))
    ordered = sets.select("n", F.explode("g").alias("t")).join(rare, "t").groupBy("n").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("o"))
    size = F.size("o")
    prefix = ordered.select("n", F.explode(F.slice("o", 1, (size - F.ceil(size * threshold) + 1).cast("int"))).alias("x")).select("n", F.col("x.t").alias("t"))
    met = prefix.alias("l").join(prefix.alias("r"), "t").where("l.n < r.n").select(F.col("l.n").alias("n1"), F.col("r.n").alias("n2")).distinct()
    g1, g2 = sets.select(F.col("n").alias("n1"), F.col("g").alias("g1")), sets.select(F.col("n").alias("n2"), F.col("g").alias("g2"))
    both = F.size(F.array_intersect("g1", "g2"))
    return met.join(g1, "n1").join(g2, "n2").withColumn("similarity", both / (F.size("g1") + F.size("g2") - both)).where(F.col("similarity") >= threshold).select("n1", "n2", "similarity")


def trigram_pairs(names: DataFrame, key: str, name: str, threshold: float = 0.5) -> DataFrame:
    """(a, b, similarity) of names at or above the threshold: of each name's rows and of each pair of names no link is lost, and no group is written out pair by pair.

    A name's least key stands for it: it is paired with the name's other keys,
    at similarity 1, and with the least keys of similar names, the smaller key
    first. Rows of null names, and of names without letters or digits, meet none.
    """
    own = names.select(F.col(key).alias("k"), F.col(name).alias("n")).where("n IS NOT NULL").where(F.size(trigrams(F.col("n"))) > 0)
    least = own.groupBy("n").agg(F.min("k").alias("first"))
    same = own.join(least, "n").where("k <> first").select(F.col("first").alias("a"), F.col("k").alias("b"), F.lit(1.0).alias("similarity"))
    near = trigram_name_pairs(own, "n", threshold)
    l1, l2 = least.select(F.col("n").alias("n1"), F.col("first").alias("f1")), least.select(F.col("n").alias("n2"), F.col("first").alias("f2"))
    met = near.join(l1, "n1").join(l2, "n2").select(F.least("f1", "f2").alias("a"), F.greatest("f1", "f2").alias("b"), "similarity")
    return same.unionByName(met).distinct()


def cross_source_duplicates(rows: DataFrame, title: str, company: str, source: str, day: str, key: str, trust: str, digest: str, days: int = 3) -> DataFrame:
    """Rows that repeat a row of another source, by normalised title and company, within `days` of it: both rows' keys, days and sources, the normalised names, content_hash_matched.

    A group's canonical row is the one of greatest trust (null as -1), then
    earliest day, then smallest key. It is found with map-side combining; a
    group's other rows meet it by key, and no group is put in order.
    """
    own = rows.select(F.col(key).alias("k"), F.col(day).alias("d"), F.col(source).alias("s"), F.col(digest).alias("h"), F.coalesce(trust, F.lit(-1)).alias("t"), normalized(F.col(title)).alias("normalized_title"), normalized(F.col(company)).alias("normalized_company"))
    group = ["normalized_title", "normalized_company"]
    first = own.groupBy(*group).agg(F.min_by(F.struct("k", "d", "s", "h"), F.struct((-F.col("t")).alias("t"), "d", "k")).alias("c"), F.min("s").alias("s1"), F.max("s").alias("s2")).where("s1 <> s2").select(*group, "c")
    met = own.join(first, group).where((F.col("k") != F.col("c.k")) & (F.col("s") != F.col("c.s")) & (F.abs(F.datediff("d", F.col("c.d"))) <= days))
    return met.select(F.col("k").alias("duplicate"), F.col("d").alias("duplicate_day"), F.col("s").alias("duplicate_source"), F.col("c.k").alias("canonical"), F.col("c.d").alias("canonical_day"), F.col("c.s").alias("canonical_source"), *group, (F.col("h") == F.col("c.h")).alias("content_hash_matched"))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")


def content_hash(title: Column, company: Column, description: Column, place: Column, low: Column, high: Column) -> Column:
    """SHA-256 of a posting's parts; bounds come as the text that is to count, nulls are empty."""
    parts = [_stripped(title), F.lower(_stripped(company)), _stripped(description), F.lower(_stripped(place)), F.coalesce(low, F.lit("")), F.coalesce(high, F.lit(""))]
    return F.sha2(F.concat_ws("|", *parts), 256)


def quality_score(disclosed: Column, place: Column, has_skills: Column, words: Column) -> Column:
    """The share of four signs that hold, to the hundredth: pay disclosed, a place, skills, twenty words or more."""
    signs = [disclosed, F.length(place) > 0, has_skills, words >= 20]
    return F.round(sum((F.coalesce(s, F.lit(False)).cast("int") for s in signs), F.lit(0)) / 4.0, 2)


def bounded_rows(rows: DataFrame, most: int) -> list:
    """At most `most` rows on the driver; more raise, since what is built from them would grow with the data."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows")
    return got


def upsert(old: DataFrame, new: DataFrame, key: str, digest: str, seen: str, values: list[str]) -> DataFrame:
    """The merged rows with `change`: kept, inserted, updated or unchanged.

    An unchanged row is only touched (`seen` moves on); an updated one takes the
    new values, a null leaving the old; the new side holds each key once.
    """
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    change = F.when(F.col(f"n.{key}").isNull(), "kept").when(F.col(f"o.{key}").isNull(), "inserted").when(F.col(f"o.{digest}").eqNullSafe(F.col(f"n.{digest}")), "unchanged").otherwise("updated")
    pick = [F.when(change == "updated", F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))).otherwise(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))).alias(c) for c in values]
    return both.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), *pick, F.when(change.isin("updated", "inserted"), F.col(f"n.{digest}")).otherwise(F.col(f"o.{digest}")).alias(digest), F.greatest(F.col(f"o.{seen}"), F.col(f"n.{seen}")).alias(seen), change.alias("change"))
