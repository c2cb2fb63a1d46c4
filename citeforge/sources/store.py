"""Tables as Parquet folders of a run, a manifest of ingested files, and a response cache
(survey SNK-01/02/06/08/16, SRC-04/08/09/20/24, AGG-01/27)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeforge.operators.ids import last_by


class Store:
    """A folder with one Parquet folder per table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def new_run(cls, spark: SparkSession, base: str, now: datetime | None = None) -> Store:
        """[SNK-08] A store in a time-stamped run folder."""
        return cls(spark, f"{base.rstrip('/')}/Run_{(now or datetime.now()):%Y%m%d_%H%M%S}")

    def _place(self, name: str) -> str:
        return f"{self.path}/table={name}"

    def exists(self, name: str) -> bool:
        """[SRC-09]"""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self._place(name))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(self._place(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._place(name))

    def drop(self, name: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self._place(name))
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Overwrite a table with a frame that may read it: written aside, then moved."""
        aside = f"{self._place(name)}.new"
        df.write.mode("overwrite").parquet(aside)
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = jpath(aside).getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(jpath(self._place(name)), True)
        fs.rename(jpath(aside), jpath(self._place(name)))
        return self.read(name)

    def tables(self) -> list[str]:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = jpath(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jpath(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(jpath(self.path))]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith("table=") and not n.endswith(".new"))

    def counts(self, wanted: list[str] | None = None) -> dict[str, int]:
        """[AGG-01] Rows by table; 0 for a table that is not there."""
        return {n: self.read(n).count() if self.exists(n) else 0 for n in wanted or self.tables()}

    def register_views(self) -> None:
        for n in self.tables():
            self.read(n).createOrReplaceTempView(n)


def new_files(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """[SRC-04, JOIN-09, SET-04] Files that the manifest does not hold."""
    return listed.join(manifest.select("src_file"), "src_file", "left_anti")


class ResponseCache:
    """[SRC-20] Responses by key with an expiry; the last response of a key counts."""

    def __init__(self, store: Store, name: str = "response_cache", ttl_days: int = 30):
        self.store, self.name, self.ttl = store, name, ttl_days

    def put(self, responses: DataFrame) -> None:
        """``responses(key, response_data)``."""
        now = F.current_timestamp()
        rows = responses.select("key", "response_data", now.alias("created_at"), (now + F.make_dt_interval(days=F.lit(self.ttl))).alias("expires_at"))
        self.store.write(self.name, rows, "append")

    def live(self) -> DataFrame:
        return last_by(self.store.read(self.name), ["key"], ["created_at"]).filter(F.col("expires_at") > F.current_timestamp())

    def missing(self, keys: DataFrame) -> DataFrame:
        """Keys to fetch: those without a live response."""
        if not self.store.exists(self.name):
            return keys
        return keys.join(self.live().select("key"), "key", "left_anti")

    def cleanup(self) -> int:
        """[SNK-06, SRC-24] Drop what has expired or was replaced; how many rows went."""
        before = self.store.read(self.name).count()
        return before - self.store.replace(self.name, self.live()).count()

    def stats(self) -> dict[str, int]:
        """[AGG-27]"""
        all_, live = self.store.read(self.name).count(), self.live().count()
        return {"total": all_, "valid": live, "expired": all_ - live}
