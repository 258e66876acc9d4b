"""Places: free text resolved to a city, region or country by a cascade of equi-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Other names of countries, and phrases that claim the whole world.
COUNTRY_ALIASES = (
    ("usa", "United States"), ("u.s.a.", "United States"), ("u.s.", "United States"), ("us", "United States"), ("america", "United States"), ("united states of america", "United States"),
    ("uk", "United Kingdom"), ("u.k.", "United Kingdom"), ("britain", "United Kingdom"), ("great britain", "United Kingdom"), ("england", "United Kingdom"),
    ("uae", "United Arab Emirates"), ("holland", "Netherlands"), ("czech republic", "Czechia"), ("korea", "South Korea"), ("south-korea", "South Korea"),
)
GLOBAL = ("worldwide", "anywhere", "anywhere in the world", "global", "globally", "international", "world")
REMOTE_PREFIX = r"^(?:remote|hybrid|on[\s-]?site)\b(?:\s+work)?(?:\s+in)?[\s\-,:]*"
ZIP_SUFFIX, COUNTY_PREFIX, DISTRICT_NUMBER = r"\b\d{5}(?:-\d{4})?\s*$", r"^co\.\s+", r"\s+\d+\s*$"
US_STATES = (
    ("al", "Alabama"), ("ak", "Alaska"), ("az", "Arizona"), ("ar", "Arkansas"), ("ca", "California"), ("co", "Colorado"), ("ct", "Connecticut"), ("de", "Delaware"), ("fl", "Florida"), ("ga", "Georgia"), ("hi", "Hawaii"),
    ("id", "Idaho"), ("il", "Illinois"), ("in", "Indiana"), ("ia", "Iowa"), ("ks", "Kansas"), ("ky", "Kentucky"), ("la", "Louisiana"), ("me", "Maine"), ("md", "Maryland"), ("ma", "Massachusetts"), ("mi", "Michigan"),
    ("mn", "Minnesota"), ("ms", "Mississippi"), ("mo", "Missouri"), ("mt", "Montana"), ("ne", "Nebraska"), ("nv", "Nevada"), ("nh", "New Hampshire"), ("nj", "New Jersey"), ("nm", "New Mexico"), ("ny", "New York"),
    ("nc", "North Carolina"), ("nd", "North Dakota"), ("oh", "Ohio"), ("ok", "Oklahoma"), ("or", "Oregon"), ("pa", "Pennsylvania"), ("ri", "Rhode Island"), ("sc", "South Carolina"), ("sd", "South Dakota"), ("tn", "Tennessee"),
    ("tx", "Texas"), ("ut", "Utah"), ("vt", "Vermont"), ("va", "Virginia"), ("wa", "Washington"), ("wv", "West Virginia"), ("wi", "Wisconsin"), ("wy", "Wyoming"), ("dc", "District of Columbia"),
)

#: A segment's level; the greatest decides, of equal ones the first.
CITY, REGION, COUNTRY, WORLD, NOTHING = 4, 3, 2, 1, 0
METHODS = {CITY: "city_exact", REGION: "region_exact", COUNTRY: "country_exact", WORLD: "global_assertion"}


def segment(text: Column) -> Column:
    """Lower case, without a leading way of working, parentheses, a postal code behind, `Co.` before, and double spaces."""
    bare = F.trim(text)
    for pattern in (REMOTE_PREFIX, r"\([^)]*\)", ZIP_SUFFIX, COUNTY_PREFIX):
        bare = F.regexp_replace(bare, "(?i)" + pattern, "")
    return F.lower(F.trim(F.regexp_replace(bare, r"\s+", " ")))


def unique_names(table: DataFrame, name: str, level: int) -> DataFrame:
    """name, level, id of the names that one row alone bears."""
    return table.where(F.col(name).isNotNull()).groupBy(F.lower(F.trim(name)).alias("name")).agg(F.count("*").alias("n"), F.min("id").cast("long").alias("id")).where("n = 1").select("name", F.lit(level).alias("level"), "id")


def _country_names(countries: DataFrame) -> DataFrame:
    """name, level, id of countries by name, other name and code."""
    spark = countries.sparkSession
    own = countries.select(F.col("id").cast("long").alias("id"), F.lower(F.trim("name")).alias("name")).where("name IS NOT NULL")
    aliases = spark.createDataFrame(list(COUNTRY_ALIASES), "alias string, of string")
    known = own.unionByName(aliases.join(own, F.lower("of") == own["name"]).select("id", F.col("alias").alias("name")))
    for code in ("iso_code_2", "iso_code_3"):
        if code in countries.columns:
            known = known.unionByName(countries.where(F.col(code).isNotNull()).select(F.col("id").cast("long").alias("id"), F.lower(code).alias("name")))
    return known.groupBy("name").agg(F.min("id").alias("id")).select("name", F.lit(COUNTRY).alias("level"), "id")


def resolve(rows: DataFrame, text: str, cities: DataFrame, regions: DataFrame, countries: DataFrame, home: str | None = None) -> DataFrame:
    """rows with place_level (0 to 4), place_id (null where nothing, or the whole world, is named) and place_method.

    Each of cities, regions and countries is (id, name), the last with its codes
    iso_code_2 and iso_code_3 where known. home names a column with the code of
    the source's own country. Texts are resolved once each, however many rows
    bear them. Segments between semicolons are looked up in turn, whole: as a
    city, also without a district's number, as a region, as a country, as the
    whole world; then the part before the first comma as a city, and the rest
    as a region or country. Where the home country is known not to be the US, a
    country goes before a region, and two letters are no American state. The
    narrowest segment decides, of equal ones the first. Where nothing is found
    the home country stands. A null text is resolved to nothing.
    """
    known = reduce(DataFrame.unionByName, [unique_names(cities, "name", CITY), unique_names(regions, "name", REGION), _country_names(countries)])
    own = rows.withColumn("__home", F.upper(home) if home else F.lit(None).cast("string"))
    texts = own.select(F.col(text).alias("raw"), F.col("__home").alias("iso")).where("raw IS NOT NULL").distinct()
    states = F.create_map(*[F.lit(x) for code, name in US_STATES for x in (code, name.lower())])
    american = F.col("iso").isNull() | (F.col("iso") == "US")

    pieces = F.filter(F.split("raw", ";"), lambda x: F.trim(x) != "")
    parts = texts.select("raw", "iso", F.posexplode(F.when(F.size(pieces) > 0, pieces).otherwise(F.array("raw"))).alias("i", "s")).withColumn("s", segment(F.col("s")))
    parts = parts.withColumn("head", F.when(F.col("s").contains(","), segment(F.substring_index("s", ",", 1)))).withColumn("tail", F.when(F.col("s").contains(","), segment(F.expr("substr(s, instr(s, ',') + 1)"))))
    plain = lambda c: F.nullif(F.trim(F.regexp_replace(c, DISTRICT_NUMBER, "")), F.lit(""))
    asked = [
        (F.col("s"), CITY), (plain("s"), CITY), (F.when(~american, F.col("s")), COUNTRY), (F.col("s"), REGION), (F.col("s"), COUNTRY),
        (F.col("head"), CITY), (plain("head"), CITY), (F.when(american, F.coalesce(F.try_element_at(states, F.col("tail")), F.col("tail"))).otherwise(F.col("tail")), REGION), (F.col("tail"), COUNTRY),
    ]
    named = parts.select("raw", "iso", "i", "s", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), c.alias("name"), F.lit(level).alias("level")) for k, (c, level) in enumerate(asked)])).alias("a")).select("raw", "iso", "i", "a.*", ((F.col("s") == "") | F.col("s").isin(*GLOBAL)).alias("world"))
    found = named.where("NOT world AND name IS NOT NULL").join(known, ["name", "level"]).groupBy("raw", "iso", "i").agg(F.min(F.struct("k", "level", "id")).alias("m")).select("raw", "iso", "i", "m.level", "m.id")
    world = named.where("world AND k = 0").select("raw", "iso", "i", F.lit(WORLD).alias("level"), F.lit(None).cast("long").alias("id"))
    best = found.unionByName(world).groupBy("raw", "iso").agg(F.max_by(F.struct("level", "id"), F.struct("level", (-F.col("i")).alias("i"))).alias("place"))
    best = best.select(F.col("raw").alias("__raw"), F.col("iso").alias("__iso"), F.col("place").alias("__place"))
    out = own.join(best, (F.col(text) == F.col("__raw")) & F.col("__home").eqNullSafe(F.col("__iso")), "left")
    if home and "iso_code_2" in countries.columns:
        codes = countries.where("iso_code_2 IS NOT NULL").groupBy(F.upper("iso_code_2").alias("__code")).agg(F.min("id").cast("long").alias("__country"))
        out = out.join(codes, F.col("__home") == F.col("__code"), "left")
    else:
        out = out.withColumn("__country", F.lit(None).cast("long"))
    level = F.coalesce("__place.level", F.when(F.col("__country").isNotNull() & F.col(text).isNotNull(), COUNTRY), F.lit(NOTHING))
    place = F.when(F.col("__place").isNull() & F.col(text).isNotNull(), F.col("__country")).otherwise(F.col("__place.id"))
    methods = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    method = F.coalesce(F.try_element_at(methods, F.col("__place.level")), F.when((level == COUNTRY) & F.col("__place").isNull(), "source_default_country"), F.lit("fallback_unmatched"))
    return out.select(*rows.columns, level.alias("place_level"), place.alias("place_id"), method.alias("place_method"))
