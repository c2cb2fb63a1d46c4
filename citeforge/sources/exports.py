"""CSV exports: discovery, scans with per-file headers, counts, and the query file
(survey SRC-01..03, SRC-05..07, SET-01)."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from citeforge.columns import bind
from citeforge.sources.rejects import WELL_FORMED

SKIPPED = re.compile(r"^[~.]|exclusion|_backup\.csv$", re.I)


def discover(folder: str) -> list[str]:
    """[SRC-03] CSV files of ``raw_scopus/`` if there is one, else of the folder, sorted by
    name; temporary files, exclusion exports and backups are left out."""
    base = Path(folder) / "raw_scopus"
    base = base if base.is_dir() else Path(folder)
    return sorted(str(p) for p in base.glob("*.csv") if not SKIPPED.search(p.name))


#: The column of a scan that holds the raw record where it does not fit the file's header.
BROKEN = "broken_record"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """[SRC-01] One export with its own header, every value a string, quoted line breaks kept,
    a byte order mark ignored; ``src_file`` and ``src_ord`` give each row's origin. A record that
    has not the header's number of fields is kept whole in ``BROKEN``, to be set aside (``rejects``).

    A record may hold line breaks, so one file is one task: exports are many files of bounded size."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}
    header = spark.read.options(**options).csv(path).columns
    fields = StructType([StructField(c, StringType()) for c in [*header, BROKEN]])
    df = spark.read.options(**options, columnNameOfCorruptRecord=BROKEN).schema(fields).csv(path)
    return df.select(
        F.lit(Path(path).name).alias("src_file"), F.monotonically_increasing_id().alias("src_ord"), BROKEN, *[F.col(f"`{c}`") for c in header]
    )


def rejects(scanned: DataFrame) -> DataFrame:
    """``src_file, src_ord, reason, raw_line`` of the records that do not load: ``quoting`` if they are
    no well-formed record, else ``columns``."""
    formed = F.col(BROKEN).rlike(WELL_FORMED)
    return scanned.filter(F.col(BROKEN).isNotNull()).select(
        "src_file", "src_ord", F.when(formed, "columns").otherwise("quoting").alias("reason"), F.col(BROKEN).alias("raw_line")
    )


def scan_all(spark: SparkSession, paths: list[str], bound: bool = True, failed: dict[str, str] | None = None) -> DataFrame:
    """[SRC-02, SET-01] Many exports by column name, whatever their column order; ``file_ord``
    is a file's place in the list. Files are bound to the engine's columns one by one, as the
    same field may have another header in each. A file that cannot be read is left out and its
    error put into ``failed``; without ``failed`` it stops the scan."""
    parts = []
    for k, p in enumerate(paths):
        try:
            df = scan(spark, p)
            df = bind(df, keep=("src_file", "src_ord", BROKEN)) if bound else df
        except (AnalysisException, ValueError) as e:
            if failed is None:
                raise
            failed[p] = str(e).splitlines()[0]
            continue
        parts.append(df.withColumn("file_ord", F.lit(k)))
    if not parts:
        raise ValueError("no files to scan")
    # Pairwise, so that the plan is as deep as the logarithm of the number of files.
    while len(parts) > 1:
        parts = [
            parts[i].unionByName(parts[i + 1], allowMissingColumns=True) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)
        ]
    return parts[0]


def record_counts(df: DataFrame) -> DataFrame:
    """[SRC-05]"""
    return df.groupBy("src_file").agg(F.count("*").alias("records"))


def query_file(path: str) -> dict[str, str | int | None]:
    """[SRC-06] The query and its total from lines ``Scopus_query=`` and ``total_results=``."""
    out: dict[str, str | int | None] = {"query": None, "total_results": None}
    for line in Path(path).read_text(encoding="utf-8", errors="replace").splitlines():
        name, _, value = line.partition("=")
        if name.strip() == "Scopus_query":
            out["query"] = value.strip()
        elif name.strip() == "total_results" and value.strip().isdigit():
            out["total_results"] = int(value.strip())
    return out


def expected_by_year(spark: SparkSession, path: str) -> DataFrame:
    """[SRC-07] ``year, expected`` of a two-column CSV; unreadable rows are left out and the
    last row of a year wins."""
    raw = spark.read.option("header", True).csv(path)
    year, n = raw.columns[:2]
    rows = raw.select(
        F.col(f"`{year}`").try_cast("int").alias("year"), F.col(f"`{n}`").try_cast("bigint").alias("expected"), F.monotonically_increasing_id().alias("k")
    ).dropna()
    return rows.groupBy("year").agg(F.max_by("expected", "k").alias("expected"))
