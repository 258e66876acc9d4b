"""Golden cases of the posting functions, and null, empty and repeated rows."""

from pyspark.sql import functions as F

from siltstone.functions import postings as p
from siltstone.operators import merges, places


def _one(spark, value, build):
    return spark.createDataFrame([(value,)], "x string").select(build(F.col("x"))).first()[0]


def test_first_pattern_decides(spark):
    assert _one(spark, "PhD or master", p.education_level) == "phd"
    assert _one(spark, "فوق لیسانس", p.education_level) == "master"
    assert _one(spark, None, p.education_level) is None
    assert _one(spark, "3 to 5 years of experience", lambda x: p.experience_level(F.lit(None).cast("string"), x)) == "mid"
    assert _one(spark, "Senior Clerk", lambda x: p.experience_level(x, F.lit("1 year experience"))) == "senior"


def test_stance_looks_for_it_first(spark):
    assert _one(spark, "No visa sponsorship is available", lambda x: p.stance(x, p.VISA)) is True
    assert _one(spark, "we cannot sponsor", lambda x: p.stance(x, p.VISA)) is False
    assert _one(spark, "", lambda x: p.stance(x, p.VISA)) is None


def test_years_roles_and_schedules(spark):
    def years(x):
        return _one(spark, x, lambda c: F.struct(*p.experience_range(c)))

    for given, want in (("از 3 تا 5 سال سابقه", (3, 5)), ("minimum 2 years relevant experience", (2, None)), ("31+ years, 4 years of experience", (4, None)), ("5 - 45 years", (None, None)), ("", (None, None)), (None, (None, None))):
        assert tuple(years(given)) == want
    role = lambda title, text: tuple(spark.createDataFrame([(title, text)], "a string, b string").select(*p.seniority(F.col("a"), F.col("b"))).first())
    assert role("Geschäftsführer", None) == ("executive", True)
    assert role("Softwareentwickler", "führung von mitarbeitern") == ("individual_contributor", False)
    assert role(None, "direct reports") == role("", "direct reports") == role("Nurse", None) == (None, None)
    assert _one(spark, "Gleitzeit", p.work_schedule) == "flexible"
    assert _one(spark, None, p.work_schedule) is None


def test_amounts_and_titles(spark):
    for given, want in (("1.234,5 €", 1234.5), ("21,000", 21000.0), ("16261,86", 16261.86), ("0", None), ("", None), (None, None), ("1,2,3.4", 123.4)):
        assert _one(spark, given, p.european_amount) == want
    assert _one(spark, "Head of Sales DACH (m/w/d) [urgent]", lambda x: p.core_title(p.clean_title(x))) == "Sales DACH"


def test_places(spark):
    named = "id long, name string"
    cities, regions, countries = spark.createDataFrame([(1, "Springfield"), (2, "springfield"), (3, "Paris")], named), spark.createDataFrame([(7, "Texas")], named), spark.createDataFrame([(9, "United States")], named)
    raw = [("Paris, Texas",), ("Springfield, USA",), ("Remote - Texas; Paris",), ("Worldwide",), ("elsewhere, ",), ("",), (None,), ("Paris, Texas",), ("Paris 12, TX",), ("x, tx 12345-6789",)]
    got = [(r["place_level"], r["place_id"]) for r in places.resolve(spark.createDataFrame(raw, "raw string").coalesce(1).withColumn("i", F.monotonically_increasing_id()), "raw", cities, regions, countries).orderBy("i").collect()]
    assert got == [(4, 3), (2, 9), (4, 3), (1, None), (0, None), (1, None), (0, None), (4, 3), (4, 3), (3, 7)]


def test_merges_of_empty_and_repeated_rows(spark):
    kind = "k long, day date, seen date"
    old = spark.createDataFrame([], kind)
    shard = spark.sql("SELECT 1L AS k, DATE '2024-01-02' AS day, DATE '2024-01-05' AS seen UNION ALL SELECT 1L, DATE '2024-01-01', DATE '2024-01-03' UNION ALL SELECT 2L, NULL, DATE '2024-01-01'")
    got = merges.merge_shard(old, shard, "k", "day", "seen").collect()
    assert [(r["k"], str(r["day"]), r["change"]) for r in got] == [(1, "2024-01-01", "inserted")]
    known = spark.createDataFrame([], "id long, name string")
    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "name string")
    assert sorted(r["id"] for r in merges.get_or_create(known, names, "id", "name").collect()) == [1, 2]
