"""Session defaults, and durable intermediate results."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """A session with the engine's defaults; the cluster's own settings stand where they are given."""
    b = SparkSession.builder.appName("docweave")
    if master:
        b = b.master(master)
    for k, v in (DEFAULTS | more).items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local master gets one of our own (tests); a cluster is refused, as each executor would write to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def durable(df: DataFrame) -> DataFrame:
    """Cuts lineage by a Parquet copy in the shared folder; it is deleted by forget(), else when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes durable copies that nothing reads any more."""
    for t in tables:
        names = {f.rsplit("/", 2)[-2] for f in t.inputFiles()}
        for made in [m for m in _made if m[1].rsplit("/", 1)[1] in names]:
            _made.remove(made)
            _delete(*made)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _sweep() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone at the end
            return


atexit.register(_sweep)
