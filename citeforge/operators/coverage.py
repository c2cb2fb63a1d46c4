"""Yearly counts, coverage against expectations, completeness and validation checks
(survey AGG-02/03/18..25, VAL, SNK-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.functions.text import blank, safe_int, split_list, text

#: Years that count as valid in the reports (fixed values).
VALID_YEARS = (1990, 2025)


def valid_year(c: str = "pub_year", span: tuple[int, int] = VALID_YEARS) -> Column:
    """[FLT-07]"""
    y = safe_int(c)
    return F.when(y.between(*span), y).cast("int")


def yearly_counts(records: DataFrame, year: Column | None = None) -> DataFrame:
    """[AGG-03] ``year, records`` of valid years."""
    y = valid_year() if year is None else year
    return records.select(y.alias("year")).filter("year is not null").groupBy("year").agg(F.count("*").alias("records"))


def year_range(records: DataFrame) -> DataFrame:
    """[AGG-02]"""
    y = safe_int("pub_year")
    return records.agg(F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.count(y).alias("with_year"))


def timeline(counts: DataFrame) -> DataFrame:
    """[SNK-14] Yearly counts without gaps. The years are a driver-independent sequence."""
    span = counts.agg(F.min("year").alias("a"), F.max("year").alias("b")).filter("a is not null")
    years = span.select(F.explode(F.sequence("a", "b")).alias("year"))
    return years.join(counts, "year", "left").select("year", F.coalesce("records", F.lit(0)).alias("records"))


def peak(counts: DataFrame, low: int = 100) -> DataFrame:
    """[AGG-22] Peak year, its count, and how many years are low."""
    return counts.agg(
        F.max_by("year", F.struct("records", -F.col("year"))).alias("peak_year"), F.max("records").alias("peak_records"),
        F.count(F.when(F.col("records") < low, 1)).alias("low_years"),
    )


def percent(part: Column, whole: Column) -> Column:
    """[NUM-02]"""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def coverage_band(rate: Column) -> Column:
    """[NUM-04]"""
    return F.when(rate >= 95, "excellent").when(rate >= 80, "good").otherwise("needs_attention")


def completeness_band(rate: Column) -> Column:
    """[NUM-05]"""
    return F.when(rate < 90, "significant").when(rate < 98, "minor").otherwise("complete")


def population_band(rate: Column, actual: Column) -> Column:
    """[NUM-03]"""
    return F.when(actual == 0, "CRITICAL_FAIL").when(rate < 50, "FAIL").when(rate < 90, "WARNING").otherwise("PASS")


def yearly_coverage(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """[JOIN-10/11, AGG-24, VAL-14/15] Expected and found by year, with a total row (year null).
    Years that only one side has come out with 0 on the other."""
    joined = expected.select("year", "expected").join(counts.select("year", "records"), "year", "full")
    filled = joined.select("year", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("records", F.lit(0)).alias("found"))
    total = filled.rollup("year").agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
    rate = percent(F.col("found"), F.col("expected"))
    return total.withColumn("coverage", rate).withColumn("status", coverage_band(rate))


def completeness(records: DataFrame, columns: list[str]) -> DataFrame:
    """[AGG-18/19/21] ``column_name, filled, total, rate`` in one pass."""
    counts = records.agg(F.count("*").alias("total"), *[F.count(F.when(~blank(c), 1)).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns]))
    return counts.select("total", rows.alias("r")).select(
        "r.column_name", "r.filled", "total", percent(F.col("filled"), F.col("total")).alias("rate")
    )


def recovery_way(records: DataFrame) -> Column:
    """[STR-28] The way in which a record's DOI could be found."""
    has_pmid = ~blank("pubmed_id") if "pubmed_id" in records.columns else F.lit(False)
    return (
        F.when(has_pmid, "pmid")
        .when(~blank("source_title") & (~blank("volume") | ~blank("page_start")), "journal")
        .when(F.length(text("title")) >= 10, "title")
        .otherwise("insufficient")
    )


def recovery_potential(records: DataFrame) -> DataFrame:
    """[AGG-20] Records without DOI by that way."""
    way = recovery_way(records)
    return records.filter(blank("doi")).groupBy(way.alias("way")).agg(F.count("*").alias("records"))


def expected_counts(records: DataFrame) -> DataFrame:
    """[AGG-04] ``item, distinct_items, items`` of the list columns."""
    lists = {"authors": "author_ids", "affiliations": "affiliations", "author_keywords": "author_keywords", "index_keywords": "index_keywords"}
    each = F.explode(
        F.array(*[F.struct(F.lit(n).alias("item"), split_list(c).alias("l")) for n, c in lists.items()])
    )
    flat = records.select(each.alias("e")).select("e.item", F.explode("e.l").alias("token"))
    return flat.groupBy("item").agg(F.countDistinct("token").alias("distinct_items"), F.count("*").alias("items"))


def population(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """[VAL-13] ``expected(item, expected)`` beside ``actual(item, actual)`` with a status."""
    joined = expected.join(actual, "item", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    rate = percent(F.col("actual"), F.col("expected"))
    return joined.withColumn("rate", rate).withColumn("status", population_band(rate, F.col("actual")))


# --- checks: each is one row (name, passed, details) ------------------------------------


def check(name: str, rows: DataFrame, passed: Column, details: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("name"), passed.alias("passed"), details.alias("details"))


def orphans(bridge: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """[JOIN-07, VAL-09] Rows of a bridge whose parent is missing."""
    return bridge.join(parent.select(key), key, "left_anti")


def no_orphans(name: str, bridge: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    n = orphans(bridge, parent, key).agg(F.count("*").alias("n"))
    return check(name, n, F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" orphaned rows")))


def unique_key(name: str, table: DataFrame, keys: list[str]) -> DataFrame:
    """[VAL-18] No key occurs twice and none is null."""
    twice = table.groupBy(*keys).agg(F.count("*").alias("__times"))
    bad = (F.col("__times") > 1) | F.greatest(*[F.col(c).isNull().cast("int") for c in keys], F.lit(0)).cast("boolean")
    n = twice.agg(F.count(F.when(bad, 1)).alias("n"))
    return check(name, n, F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" keys not unique")))


def same_count(name: str, a: DataFrame, b: DataFrame, tolerance: int = 0) -> DataFrame:
    """[VAL-01, VAL-03, VAL-04] Two tables of as many rows, within a tolerance."""
    both = a.agg(F.count("*").alias("x")).join(b.agg(F.count("*").alias("y")), F.lit(True))
    return check(name, both, F.abs(F.col("x") - F.col("y")) <= tolerance, F.concat_ws(" of ", F.col("x").cast("string"), F.col("y").cast("string")))


def not_empty(name: str, table: DataFrame, if_any: DataFrame | None = None) -> DataFrame:
    """[VAL-05..08, VAL-12] Rows exist, if the source has any."""
    n = table.agg(F.count("*").alias("n"))
    if if_any is None:
        return check(name, n, F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" rows")))
    both = n.join(if_any.agg(F.count("*").alias("m")), F.lit(True))
    return check(name, both, (F.col("n") > 0) | (F.col("m") == 0), F.concat_ws(" of ", F.col("n").cast("string"), F.col("m").cast("string")))


def special_characters(name: str, table: DataFrame, source: DataFrame, key: str, column: str = "title") -> DataFrame:
    """[VAL-10, FLT-10] Values of the source with letters outside ASCII are stored as they are."""
    theirs = source.select(key, text(column).alias("s")).filter(F.col("s").rlike(r"[^\x00-\x7f]"))
    joined = theirs.join(table.select(key, F.col(column).alias("t")), key, "left")
    n = joined.agg(F.count("*").alias("n"), F.count(F.when(~F.col("s").eqNullSafe(F.col("t")), 1)).alias("bad"))
    return check(name, n, F.col("bad") == 0, F.concat(F.col("n").cast("string"), F.lit(" with special characters, "), F.col("bad").cast("string"), F.lit(" changed")))


def same_content(name: str, table: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """[VAL-02] Every row of the source is stored with the same texts, whatever their number."""
    mine = table.select(key, F.struct(*[text(c).alias(c) for c in columns]).alias("m"), F.lit(1).alias("there"))
    joined = source.select(key, F.struct(*[text(c).alias(c) for c in columns]).alias("t")).join(mine, key, "left")
    n = joined.agg(F.count(F.when(~F.col("t").eqNullSafe(F.col("m")), 1)).alias("n"))
    return check(name, n, F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" rows differ")))


def first_author(name: str, bridge: DataFrame, masters: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """[VAL-03, JOIN-19] The first record that lists an author with an id has it in first place."""
    given = source.filter((F.size(split_list("authors")) > 0) & (F.size(split_list("author_ids")) > 0))
    first = given.agg(F.min(key).alias(key), F.count("*").alias("m"))
    hit = first.join(bridge.filter("position = 1"), key, "left").join(masters.select("author_id", F.lit(1).alias("known")), "author_id", "left")
    n = hit.agg(F.max("m").alias("m"), F.count("known").alias("n"))
    return check(name, n, (F.col("m") == 0) | (F.col("n") > 0), F.concat(F.col("n").cast("string"), F.lit(" first authors of the first record")))


def near_counts(name: str, counts: DataFrame, expected: DataFrame, key: str, percent_off: float = 5.0) -> DataFrame:
    """[VAL-04] ``expected(key, n)`` beside ``counts(key, n)``: none is off by ``percent_off`` or more."""
    joined = expected.select(key, F.col("n").alias("e")).join(counts.select(key, F.col("n").alias("a")), key, "full")
    e, a = F.coalesce("e", F.lit(0)), F.coalesce("a", F.lit(0))
    off = F.when(e > 0, F.abs(a - e) * 100.0 / e).otherwise(F.when(a > 0, 100.0).otherwise(0.0))
    n = joined.agg(F.coalesce(F.max(off), F.lit(0.0)).alias("worst"))
    return check(name, n, F.col("worst") < percent_off, F.concat(F.format_number("worst", 1), F.lit(" % off at most")))


def worst_years(coverage_rows: DataFrame, most: int | None = None) -> DataFrame:
    """[ORD-06] Years (without the total) from the least coverage up."""
    out = coverage_rows.filter("year is not null").orderBy("coverage", "year")
    return out.limit(most) if most else out


def few_blank(name: str, table: DataFrame, column: str, most: float = 10.0) -> DataFrame:
    """[VAL-11]"""
    n = table.agg(F.count("*").alias("m"), F.count(F.when(blank(column), 1)).alias("n"))
    rate = percent(F.col("n"), F.col("m"))
    return check(name, n, rate < most, F.concat(F.format_number(rate, 2), F.lit(" % blank")))


def run_all(checks: list[DataFrame]) -> DataFrame:
    """[VAL-16] The rows of all checks."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
