"""Tables parsed from the complex fields of a record (survey PIPE-10..12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeforge.functions.references import parse_references
from citeforge.functions.text import agency, blank, chemical, correspondence, grants, open_access, split_list, strip, text, trade_name


def references(records: DataFrame, order: str, longest: int = 500) -> DataFrame:
    """[PIPE-11] ``order, position, reference_text`` and the parsed parts of every reference."""
    each = records.select(order, F.posexplode(split_list("ref_list")).alias("p", "reference"))
    parsed = parse_references(each, "reference")
    return parsed.select(
        order, (F.col("p") + 1).alias("position"), F.substring("reference", 1, longest).alias("reference_text"),
        *[F.col(f"parsed.{f}").alias(f"reference_{f}") for f in ("authors", "title", "journal", "volume", "issue", "pages", "year")],
    )


def funding(records: DataFrame, order: str, column: str = "funding") -> DataFrame:
    """[PIPE-10] ``order, funding_id, agency_name, grant_numbers``."""
    each = records.select(order, F.posexplode(split_list(column)).alias("p", "entry"))
    return each.select(
        order, (F.col("p") + 1).alias("funding_id"), agency("entry").alias("agency_name"), grants("entry").alias("grant_numbers")
    ).filter(F.col("agency_name").isNotNull())


def chemicals(records: DataFrame, order: str) -> DataFrame:
    each = records.select(order, F.posexplode(split_list("chemicals")).alias("p", "entry"))
    return each.select(order, (F.col("p") + 1).alias("position"), chemical("entry").alias("c")).select(order, "position", "c.*").filter("chemical_name <> ''")


def trade_names(records: DataFrame, order: str) -> DataFrame:
    each = records.select(order, F.posexplode(split_list("trade_names")).alias("p", "entry"))
    return each.select(order, (F.col("p") + 1).alias("position"), trade_name("entry").alias("t")).select(order, "position", "t.*").filter("trade_name <> ''")


def correspondences(records: DataFrame, order: str) -> DataFrame:
    parsed = records.filter(~blank("correspondence")).select(order, correspondence("correspondence").alias("c"))
    return parsed.select(order, "c.*").filter("author_name <> ''")


def access(records: DataFrame, order: str) -> DataFrame:
    shaped = records.select(order, strip(text("access_type")).alias("access_type"), strip(text("publisher")).alias("publisher"))
    return shaped.filter("access_type <> '' or publisher <> ''").withColumn("open_access", open_access("access_type"))
