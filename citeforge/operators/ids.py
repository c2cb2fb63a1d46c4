"""Dense surrogate ids and keep-first/keep-last rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeforge.session import cut


def dense_ids(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out`` = 1..n in the order of ``order`` (a total order).

    The rows are range-partitioned once; each partition numbers its own rows and adds the size
    of the partitions before it. No task sees more than its range, unlike a window without
    partition keys. The ranges are written, as a second run may draw other borders."""
    part, place = "__part", "__place"
    ranged = cut(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(part).agg(F.count("*").alias("__n"))
    # As many rows as partitions.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    numbered = ranged.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    return numbered.join(starts, part).withColumn(out, F.col("__start") + F.col(place)).drop(part, place, "__start")


def first_by(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of every key [SNK-03]. Aggregated before it is shuffled, so that a key
    that holds a third of all rows is one row per partition when it travels."""
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    least = F.min_by(row, F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]))
    keyed = {f"__k{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    return df.withColumns(keyed).groupBy(*keyed).agg(least.alias("__r")).select("__r.*")


def last_by(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The last row of every key [SNK-04]."""
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    most = F.max_by(row, F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]))
    keyed = {f"__k{i}": F.col(k) if isinstance(k, str) else k for i, k in enumerate(keys)}
    return df.withColumns(keyed).groupBy(*keyed).agg(most.alias("__r")).select("__r.*")


def insert_or_ignore(existing: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``existing`` and those first ``rows`` of each key that it does not hold."""
    new = first_by(rows, list(keys), list(order)).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def insert_or_replace(existing: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``existing`` with the rows of the keys in ``rows`` replaced by the last of them."""
    new = last_by(rows, list(keys), list(order))
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*existing.columns))


def update_by_key(existing: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``existing`` with the non-null values of ``updates`` [SNK-05]; one update per key."""
    new = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = existing.join(new, key, "left")
    out = [F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in existing.columns]
    return joined.select(*out)


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``df`` with columns it lacks added as nulls [SNK-07]."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})
