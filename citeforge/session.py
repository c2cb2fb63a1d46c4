"""Session factory and the two helpers every multi-pass operator shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Local folders by application.
_LOCAL: dict[str, str] = {}


def build_session(app: str = "citeforge", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` when set, else the context's
    checkpoint folder, else, in local mode only (as in tests), a local one that goes with the process."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="citeforge-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return "file://" + _LOCAL[app]


def clear_cuts(spark: SparkSession) -> None:
    """Remove what ``cut`` of this application has written; frames that read it are void then."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    for path in _CUTS.pop(spark.sparkContext.applicationId, []):
        jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath(path), True)


#: Folders written by ``cut``, by application.
_CUTS: dict[str, list[str]] = {}


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives the
    loss of executors, and a barrier after which its columns are plain scan columns."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _CUTS.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
