"""The posting store's state machines, as functions from tables to tables.

Saving postings with their pay and its history, proposing and rejecting company
aliases, pushing rows between stores with ids of their own, guarding a merge.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def save_postings(old: DataFrame, new: DataFrame, key: str, digest: str, seen: str, replaced: Iterable[str], filled: Iterable[str], followed: Iterable[str], low: str, high: str) -> DataFrame:
    """Every key's row with `change` and `pay_history`.

    A key that is not known comes in whole. One whose digest is the same is
    touched: `seen` moves on, `followed` columns take the new value whatever it
    is, `filled` ones only where the new value is not null. One whose digest
    differs also takes the `replaced` columns and the pay. pay_history says
    whether the pay is to be noted: on arrival, and when an update brings other
    bounds where all four are known. A key that the new side lacks is kept.
    Each side holds a key once.
    """
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    was, now = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    change = F.when(now(key).isNull(), "kept").when(was(key).isNull(), "inserted").when(was(digest).eqNullSafe(now(digest)), "unchanged").otherwise("updated")
    fresh, arrived = change.isin("inserted", "updated"), change != "kept"
    known = was(low).isNotNull() & was(high).isNotNull() & now(low).isNotNull() & now(high).isNotNull()
    moved = (change == "updated") & known & ((was(low) != now(low)) | (was(high) != now(high)))
    take = lambda c, when: F.when(when, now(c)).otherwise(was(c)).alias(c)
    return both.select(
        F.coalesce(was(key), now(key)).alias(key),
        *[take(c, fresh) for c in (*replaced, low, high, digest)],
        *[F.coalesce(now(c), was(c)).alias(c) for c in filled],
        *[take(c, arrived) for c in followed],
        F.greatest(was(seen), now(seen)).alias(seen),
        change.alias("change"),
        ((change == "inserted") | moved).alias("pay_history"),
    )


def touched(state: DataFrame, batch: DataFrame, key: str, digest: str, seen: str) -> DataFrame:
    """The state after a batch: of each key the last digest and time by time; a key that comes again unchanged only moves on."""
    rows = state.select(key, digest, seen).unionByName(batch.select(key, digest, seen))
    return rows.groupBy(key).agg(F.max_by(digest, F.struct(seen, digest)).alias(digest), F.max(seen).alias(seen))


# ---- company aliases


def canonical_first(pairs: DataFrame) -> DataFrame:
    """pairs: a_id, a_name, a_jobs, b_id, b_name, b_jobs, similarity. Which of two companies is the alias of which: the one of more postings, then of the smaller id, is canonical."""
    a, b = F.struct((-F.col("a_jobs")).alias("j"), F.col("a_id").alias("i")), F.struct((-F.col("b_jobs")).alias("j"), F.col("b_id").alias("i"))
    first = a < b
    pick = lambda when, x, y, name: F.when(when, F.col(x)).otherwise(F.col(y)).alias(name)
    return pairs.select(pick(first, "a_id", "b_id", "company_id"), pick(first, "a_name", "b_name", "company_name"), pick(first, "b_id", "a_id", "alias_id"), pick(first, "b_name", "a_name", "raw_name"), "similarity")


def without_rejected(pairs: DataFrame, log: DataFrame) -> DataFrame:
    """pairs of which neither side was rejected as the other's alias. log: table_name, record_id, operation, old_data (JSON)."""
    gone = log.where("table_name = 'company_aliases' AND operation = 'delete'").select(F.col("record_id").alias("r_id"), F.get_json_object("old_data", "$.alias_raw_name").alias("r_name")).where("r_id IS NOT NULL AND r_name IS NOT NULL").distinct()
    for mine, other in (("a_id", "b_name"), ("b_id", "a_name")):
        pairs = pairs.join(gone, (pairs[mine] == gone["r_id"]) & (pairs[other] == gone["r_name"]), "left_anti")
    return pairs


def propose(aliases: DataFrame, candidates: DataFrame) -> DataFrame:
    """aliases (company_id, raw_name, match_confidence) with the candidates that are not among them yet, their similarity to the hundredth."""
    new = candidates.groupBy("company_id", "raw_name").agg(F.round(F.max("similarity"), 2).alias("match_confidence"))
    return aliases.unionByName(new.join(aliases, ["company_id", "raw_name"], "left_anti"))


def reject(aliases: DataFrame, log: DataFrame, rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """aliases without the rejected (company_id, raw_name), and the log with a deletion of each: what was rejected is not proposed again."""
    note = F.to_json(F.struct(F.lit("company_alias_review").alias("actor"), F.col("company_id").alias("canonical_company_id"), F.col("raw_name").alias("alias_raw_name")))
    rows = rejected.select("company_id", "raw_name").distinct()
    entries = rows.select(F.lit("company_aliases").alias("table_name"), F.col("company_id").alias("record_id"), F.lit("delete").alias("operation"), note.alias("old_data"))
    return aliases.join(rows, ["company_id", "raw_name"], "left_anti"), log.unionByName(entries)


def alias_groups(companies: DataFrame, aliases: DataFrame) -> DataFrame:
    """Of each company that is not verified its aliases' ids, names and confidences, as arrays that run side by side by id."""
    met = companies.where(~F.col("is_verified")).join(aliases, "company_id")
    rows = met.groupBy("company_id", "company_name").agg(F.sort_array(F.collect_list(F.struct("alias_id", "raw_name", "match_confidence"))).alias("a"))
    return rows.select("company_id", "company_name", F.col("a.alias_id").alias("alias_ids"), F.col("a.raw_name").alias("raw_names"), F.col("a.match_confidence").alias("confidences"))


# ---- between stores


def push(here: DataFrame, there: DataFrame, key: list[str], filled: Iterable[str], first: str, last: str) -> DataFrame:
    """The rows of another store after those of this one were pushed into it: there_id, key, columns, duplicate_of, change.

    here: id, key, filled, first, last, duplicate_of (an id of this store, which
    must be pushed too). there: the same under its own ids. Rows meet by key. A
    known one takes what is not null, the earlier first and the later last time;
    a new one is numbered on from the other store's greatest id, in order of
    this store's. duplicate_of is carried over by the map of ids.
    """
    top = F.broadcast(there.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("top")))  # one row
    h, t = here.alias("h"), there.alias("t")
    met = h.join(t, [F.col(f"h.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key], "full_outer")
    change = F.when(F.col("h.id").isNull(), "kept").when(F.col("t.id").isNull(), "inserted").otherwise("updated")
    rows = met.select(F.col("h.id").alias("here_id"), F.col("t.id").alias("t_id"), F.col("h.duplicate_of").alias("here_duplicate"), F.col("t.duplicate_of").alias("t_duplicate"),
                      *[F.coalesce(F.col(f"h.{c}"), F.col(f"t.{c}")).alias(c) for c in (*key, *filled)], F.least(f"h.{first}", f"t.{first}").alias(first), F.greatest(f"h.{last}", f"t.{last}").alias(last), change.alias("change"))
    from .merges import numbered

    ids = numbered(rows.where("change = 'inserted'").select("here_id"), "here_id").crossJoin(top).select("here_id", (F.col("top") + F.col("i")).alias("new_id"))
    rows = rows.join(ids, "here_id", "left").withColumn("there_id", F.coalesce("t_id", "new_id"))
    of = rows.where("here_id IS NOT NULL").select(F.col("here_id").alias("d_id"), F.col("there_id").alias("d_there"))
    out = rows.join(of, F.col("here_duplicate") == F.col("d_id"), "left")
    linked = F.when(F.col("here_duplicate").isNull(), F.col("t_duplicate")).when(F.col("d_there").isNull(), F.raise_error(F.concat(F.lit("duplicate_of points outside the push: "), F.col("here_duplicate").cast("string"))).cast("long")).otherwise(F.col("d_there"))
    return out.select("there_id", *key, *filled, first, last, linked.alias("duplicate_of"), "change")


def translated(ids: DataFrame, here: DataFrame, there: DataFrame, column: str) -> DataFrame:
    """ids with the column's reference ids of this store turned into the other's by their natural values (id, value on both sides); a value that the other lacks raises."""
    a, b = here.select(F.col("id").alias("a_id"), F.col("value").alias("a_value")), there.select(F.col("id").alias("b_id"), F.col("value").alias("b_value"))
    met = ids.join(a, F.col(column) == F.col("a_id"), "left").join(b, F.col("a_value") == F.col("b_value"), "left")
    absent = F.raise_error(F.concat(F.lit(f"no value for {column} "), F.col(column).cast("string"))).cast("long")
    return met.withColumn(column, F.when(F.col(column).isNotNull() & F.col("b_id").isNull(), absent).otherwise(F.col("b_id"))).drop("a_id", "a_value", "b_id", "b_value")


def remapped(rows: DataFrame, key: str, link: str, ids: DataFrame) -> DataFrame:
    """rows with their key and the link to another row of theirs turned by ids (old_id, new_id, each once); a link that the map lacks raises."""
    own, other = ids.select(F.col("old_id").alias("k_old"), F.col("new_id").alias("k_new")), ids.select(F.col("old_id").alias("l_old"), F.col("new_id").alias("l_new"))
    met = rows.join(own, F.col(key) == F.col("k_old")).join(other, F.col(link) == F.col("l_old"), "left")
    absent = F.raise_error(F.concat(F.lit(f"{link} is not mapped: "), F.col(link).cast("string"))).cast("long")
    return met.withColumns({link: F.when(F.col(link).isNotNull() & F.col("l_new").isNull(), absent).otherwise(F.col("l_new")), key: F.col("k_new")}).select(*rows.columns)


#: Columns that a merge keeps for itself.
OWN_COLUMNS = ("rn", "src_priority", "priority")


def guarded(merged: DataFrame, inputs: list[DataFrame], key: list[str], needed: Iterable[str]) -> DataFrame:
    """merged, if it may be published; else ValueError: as many keys as the inputs hold together, no fewer rows than the largest input, no key twice, no column lost and none of the merge's own left."""
    if lost := set(needed) - set(merged.columns):
        raise ValueError(f"columns lost: {sorted(lost)}")
    if own := set(OWN_COLUMNS) & set(merged.columns):
        raise ValueError(f"columns of the merge's own: {sorted(own)}")
    keys = reduce(DataFrame.unionByName, [i.select(*key) for i in inputs]).distinct().count()
    rows, different = merged.agg(F.count(F.lit(1)), F.count_distinct(F.struct(*key))).first()
    if different != keys:
        raise ValueError(f"merged holds {different} keys, the inputs {keys}")
    if rows < max(i.count() for i in inputs):
        raise ValueError("merged is smaller than an input")
    if rows != different:
        raise ValueError(f"{rows - different} keys are repeated")
    return merged


# ---- files and ages


def in_fold_order(files: DataFrame, ledger: DataFrame, path: str, source: str, last: str) -> DataFrame:
    """files with `place`: of a source's Parquet shards the ledger's last path first, then the newest name first."""
    shards = files.where(F.col(path).startswith("shards/") & F.col(path).endswith(".parquet"))
    met = shards.join(ledger.select(source, F.col(last).alias("__last")), source, "left")
    order = F.struct(F.coalesce(F.col(path) != F.col("__last"), F.lit(True)).alias("o"), F.col(path).alias("p"))
    flagged = met.groupBy(source).agg(F.collect_list(order).alias("all"))
    ranked = F.array_sort(F.col("all"), lambda a, b: F.when(a["o"] != b["o"], F.when(a["o"], 1).otherwise(-1)).when(a["p"] < b["p"], 1).when(a["p"] > b["p"], -1).otherwise(0))
    return flagged.select(source, F.posexplode(ranked).alias("place", "f")).select(source, F.col("f.p").alias(path), (F.col("place") + 1).alias("place"))


def prunable(rows: DataFrame, ledger: DataFrame, now: Column, days: int, first: str, source: str) -> DataFrame:
    """Rows first seen more than `days` before now, of sources of which the ledger holds a merge; younger ones are never pruned."""
    merged = ledger.where("merged_at IS NOT NULL").select(source).distinct()
    return rows.where(F.col(first) < now - F.expr(f"INTERVAL {days} DAYS")).join(merged, source, "left_semi")
