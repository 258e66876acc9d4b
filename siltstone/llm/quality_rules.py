"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is a built-in expression of one row, so the plan is a scan and a
projection: no shuffle, no user function, and nothing that grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, WS, let, read

#: Frequent function words of the corpus' languages.
STOP_WORDS = (
    "the of and to in that is was for with on as are this be by it from or an",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "de la le et les des en un du une que est pour qui dans par sur au avec ne",
    "de la que el en y a los se del las un por con no una su para es al",
)


def stop_forms() -> list[str]:
    """The stop words in lower case, with a capital, and in capitals: no text has to be lower-cased to find them."""
    return sorted({f for line in STOP_WORDS for w in line.split() for f in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= metric <= high; an open end is None."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are 0 where their denominator is 0.
RULES = (
    Rule("length", "n_words", 10, 200_000),
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbol_ratio", None, 0.10),
    Rule("shouting", "upper_ratio", None, 0.50),
    Rule("exclamations", "exclamation_ratio", None, 0.30),
    Rule("stop_words", "stop_word_ratio", 0.01, None),
    Rule("distinct_words", "distinct_word_ratio", 0.05, None),
    Rule("dup_lines", "dup_line_ratio", None, 0.40),
    Rule("bullets", "bullet_line_ratio", None, 0.90),
    Rule("repeats", "repeat_word_ratio", None, 0.20),
)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), rf"[{WS}]+"), "")


def _repeated(words: Column) -> Column:
    """How many word positions lie in a five-word window that occurs twice or more.

    Windows are compared by a 64-bit hash within one document. Texts without a
    repeated window, nearly all, end at the first test; the others sort their
    windows, keep those equal to a neighbour and add up what these cover.
    """

    def covered(hashes: Column, size: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda p: F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"])))
        # get() is null beyond either end, and null | true is true
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(p, i + 1) - x, F.lit(5)))), F.lit(0), lambda a, b: a + b))

    def of(w: Column) -> Column:
        size = F.size(w)

        def join(a: Column, b: Column) -> Column:
            return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

        def fives(h: Column) -> Column:
            fours = let(join(F.slice(h, 1, size - 1), F.slice(h, 2, size - 1)), lambda p: join(F.slice(p, 1, size - 3), F.slice(p, 3, size - 3)))
            return join(F.slice(fours, 1, size - 4), F.slice(h, 5, size - 4))

        windows = let(F.transform(w, lambda x: F.xxhash64(x)), fives)
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h, F.size(w))))

    return F.when(F.size(words) < 5, F.lit(0)).otherwise(let(words, of)).cast("long")


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the metric columns added; text is read whole, and null has no words."""
    t = F.coalesce(F.col(text), F.lit(""))
    stops = stop_forms()
    own = docs.withColumn("__w", _words(F.col(text)))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    own = own.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_bullets": F.size(F.filter(lines, lambda x: F.trim(x).rlike(r"^[-*•]\s"))).cast("long"),
        "n_repeat_words": _repeated(F.col("__w")),
        "n_stop_words": F.size(F.filter("__w", lambda w: w.isin(stops))).cast("long"),
        "n_distinct": F.size(F.array_distinct("__w")).cast("long"),
        "n_upper": F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long"),
        "n_letters": F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("long"),
        "n_exclamations": F.length(F.regexp_replace(t, r"[^!]+", "")).cast("long"),
    })

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return own.drop("__w").withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "upper_ratio": ratio("n_upper", "n_letters"),
        "exclamation_ratio": ratio("n_exclamations", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "distinct_word_ratio": ratio("n_distinct", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullets", "n_lines"),
        "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
    })


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of metrics() breaks, as an array."""
    broken = []
    for r in rules:
        m, bad = F.col(r.metric), F.lit(False)
        bad = bad | (m < r.low) if r.low is not None else bad
        bad = bad | (m > r.high) if r.high is not None else bad
        broken.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: its columns but the text, the metrics, failed_rules, base_failed and kept.

    A null or empty text has no words and fails. Rows are judged alone, so
    repeated rows get equal verdicts and an empty table gives an empty result.
    Columns of docs named like a metric are replaced.
    """
    names = ("n_words word_chars n_symbols n_dup_lines n_lines n_bullets n_repeat_words n_stop_words n_distinct n_upper n_letters n_exclamations").split()
    found = metrics(docs.drop(*(n for n in names if n != text)), text)
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return found.withColumn("failed_rules", verdict(rules)).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop(text)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOPS = ", ".join(f"'{w}'" for w in stop_forms())

OP1_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i AS p, list_slice(ws, i, i + 4) AS g FROM w, unnest(generate_series(1, len(ws) - 4)) AS u(i)),
rep AS (SELECT rid, p FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
cov AS (SELECT rid, least(5, coalesce(lead(p) OVER (PARTITION BY rid ORDER BY p) - p, 5)) AS c FROM rep),
r AS (SELECT rid, sum(c) AS n FROM cov GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (
  SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '^ *[-*•][\t\n\v\f\r ]'))) AS n_bullets,
    len(list_filter(w.ws, lambda x: x IN ({_STOPS}))) AS n_stop,
    len(list_distinct(w.ws)) AS n_distinct,
    length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper,
    length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters,
    length(t) - length(replace(t, '!', '')) AS n_excl
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND n_words <= 200000 AND word_chars BETWEEN 2.0 * n_words AND 14.0 * n_words
    AND n_symbols::DOUBLE / n_words <= 0.10 AND (n_letters = 0 OR n_upper::DOUBLE / n_letters <= 0.50)
    AND n_excl::DOUBLE / n_words <= 0.30 AND n_stop::DOUBLE / n_words >= 0.01 AND n_distinct::DOUBLE / n_words >= 0.05
    AND n_dup_lines::DOUBLE / n_lines <= 0.40 AND n_bullets::DOUBLE / n_lines <= 0.90
    AND n_repeat_words::DOUBLE / n_words <= 0.20 AS kept
FROM m
"""
