"""Quality filter with reasons, and de-duplication by DOI (survey FLT, PIPE-01/02)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeforge.functions.text import blank, safe_int, strip, text
from citeforge.operators.ids import first_by

# The required fields in the order in which they are tested.
REQUIRED = ["authors", "author_ids", "title", "year", "affiliations", "abstract"]
REQUIRED_STRICT = ["authors", "author_ids", "title", "year", "doi", "affiliations", "abstract"]
COLUMN_OF = {"year": "pub_year"}
CATEGORY_NAMES = {
    "MISSING_AUTHORS": "Missing Author Names",
    "MISSING_AUTHOR_IDS": "Missing Author IDs",
    "MISSING_TITLE": "Missing Title",
    "MISSING_YEAR": "Missing Publication Year",
    "MISSING_DOI": "Missing DOI",
    "MISSING_AFFILIATIONS": "Missing Institution Info",
    "MISSING_ABSTRACT": "Missing Abstract",
}
CATEGORY_IMPACTS = {
    "MISSING_AUTHORS": "The record names nobody as its author",
    "MISSING_AUTHOR_IDS": "Authors stay unlinked to their other papers",
    "MISSING_TITLE": "Neither search nor matching by title works",
    "MISSING_YEAR": "The record is left out of every yearly count",
    "MISSING_DOI": "The original can't be looked up by identifier",
    "MISSING_AFFILIATIONS": "No institution or country is credited",
    "MISSING_ABSTRACT": "Only the title tells what the record is about",
}


def missing_reason(strict: bool = False, enabled: bool = True, wanted: list[str] | None = None) -> Column:
    """[FLT-01..03] The reason of the first blank required field, null if all are given. Of the
    required fields only those in ``wanted`` are tested, if it is given."""
    fields = (REQUIRED_STRICT if strict else REQUIRED) if enabled else []
    fields = fields if wanted is None else [f for f in fields if f in wanted]
    reasons = [
        F.when(blank(COLUMN_OF.get(f, f)), F.lit(f"MISSING_{f.upper()}: No {f.replace('_', ' ')} provided")) for f in fields
    ]
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def category(reason: Column | str) -> Column:
    """[FLT-04] What stands before the first colon."""
    r = F.col(reason) if isinstance(reason, str) else reason
    return F.when(F.contains(r, F.lit(":")), F.substring_index(r, ":", 1)).when(r.isNotNull(), "OTHER")


def clean_key(name: str) -> str:
    """[FLT-05] A header as a key of the exclusion log."""
    return re.sub(r"[ -]", "_", re.sub(r"[()]", "", name.lower()))


def flagged(df: DataFrame, strict: bool = False, enabled: bool = True, wanted: list[str] | None = None) -> DataFrame:
    """``df`` with ``reason`` and ``category``: one pass that both outputs are taken from."""
    with_reason = df.withColumn("reason", missing_reason(strict, enabled, wanted))
    return with_reason.withColumn("category", category("reason"))


def kept(df: DataFrame, strict: bool = False) -> DataFrame:
    return flagged(df, strict).filter(F.col("reason").isNull()).drop("reason", "category")


def excluded(df: DataFrame, strict: bool = False) -> DataFrame:
    return flagged(df, strict).filter(F.col("reason").isNotNull())


def breakdown(df: DataFrame, strict: bool = False) -> DataFrame:
    """[AGG-05] ``category, excluded, rate`` in per cent of all records."""
    counted = flagged(df, strict).groupBy("category").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return (
        counted.filter(F.col("category").isNotNull())
        .join(total, F.lit(True))
        .select("category", F.col("n").alias("excluded"), (F.col("n") * 100.0 / F.col("total")).alias("rate"))
    )


def friendly(category_col: str = "category") -> Column:
    """[STR-22, STR-23] A category's title, and its impact, from fixed tables."""
    pairs = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    c = F.col(category_col)
    titled = F.initcap(F.replace(F.lower(c), F.lit("_"), F.lit(" ")))
    return F.struct(
        F.coalesce(pairs(CATEGORY_NAMES)[c], titled).alias("friendly_name"),
        F.coalesce(pairs(CATEGORY_IMPACTS)[c], F.lit("Unknown impact")).alias("impact"),
    )


def grade(rate: Column) -> Column:
    """[NUM-06] Grade of an exclusion rate in per cent."""
    return F.when(rate < 5, "excellent").when(rate < 15, "good").when(rate < 30, "fair").otherwise("poor")


def dedup_by_doi(df: DataFrame, order: list[str]) -> DataFrame:
    """[WIN-05, PIPE-01] The first record of every DOI (stripped, case kept) and all records
    without one. Records of a DOI are reduced before the shuffle."""
    doi = strip(text("doi"))
    with_key = df.withColumn("__doi", doi)
    blanks = with_key.filter(F.col("__doi") == "").drop("__doi")
    firsts = first_by(with_key.filter(F.col("__doi") != ""), ["__doi"], list(order)).drop("__doi")
    return firsts.select(*df.columns).unionByName(blanks)


def duplicate_log(df: DataFrame, order: list[str], id_col: str) -> DataFrame:
    """``doi, id, kept_id, year`` of every record that a first one of its DOI displaces."""
    keyed = df.select(id_col, strip(text("doi")).alias("doi"), plausible_year("pub_year").alias("year"), *[c for c in order if c != id_col])
    keyed = keyed.filter(F.col("doi") != "")
    firsts = keyed.groupBy("doi").agg(F.min_by(F.col(id_col), F.struct(*order)).alias("kept_id"), F.count("*").alias("n")).filter("n > 1")
    return keyed.join(firsts.select("doi", "kept_id"), "doi").filter(F.col(id_col) != F.col("kept_id")).select("doi", id_col, "kept_id", "year")


def plausible_year(c: str) -> Column:
    """[FLT-08]"""
    y = safe_int(c)
    return F.when(y.between(2000, 2030), y).cast("int")


def exclusions_by_year(df: DataFrame, strict: bool = False) -> DataFrame:
    """[AGG-28] Records and excluded records of every year."""
    y = safe_int("pub_year").cast("int")
    flags = flagged(df, strict).select(y.alias("year"), F.col("reason").isNotNull().alias("out"))
    return flags.groupBy("year").agg(F.count("*").alias("records"), F.count(F.when(F.col("out"), 1)).alias("excluded"))


def exclusion_samples(df: DataFrame, order: str, strict: bool = False) -> DataFrame:
    """[WIN-08] The first excluded record of every category."""
    return first_by(excluded(df, strict).select(order, "category", "reason", "title"), ["category"], [order])
