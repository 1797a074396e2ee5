"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: White space of the token definition: space and the six ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a local master gets one of our own (tests); a cluster is refused, as each executor would write to its own disk."""
    name = spark.conf.get("spark.checkpoint.dir", None)
    if not name:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name = tempfile.mkdtemp(prefix="docweave-")
        spark.conf.set("spark.checkpoint.dir", name)
    return name


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bounds what the JVM and a Python worker hold of long texts at a time. Stays set, as results are read later; a smaller bound of the session's own stands."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, rows):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def durable(df: DataFrame) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and returns it as read from there.

    A lost executor then costs only the tasks it ran, and rows that carry generated ids keep them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _sweep() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone at exit
            return


atexit.register(_sweep)


def bucketed(df: DataFrame, key: str, buckets: int) -> tuple[DataFrame, Callable[[], None]]:
    """durable(), in buckets by key that grouping by it reads without a shuffle, and what drops the copy."""
    spark = df.sparkSession
    name = f"docweave_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    _made.append((spark, path))

    def drop() -> None:
        spark.sql(f"DROP TABLE {name}")
        _made.remove((spark, path))
        _delete(spark, path)

    return spark.table(name), drop


def forget(*tables: DataFrame) -> None:
    """Deletes durable copies whose readers are done."""
    for t in tables:
        for name in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            for made in [m for m in _made if m[1].rsplit("/", 1)[1] == name.rsplit("/", 1)[1]]:
                _made.remove(made)
                _delete(*made)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_table(spark: SparkSession, rows: list[list], schema: str) -> DataFrame:
    """A table of a bounded number of driver-side rows, as an expression: no RDD, no Python on executors."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(':'.join(c.split()) for c in schema.split(', '))}>>")))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


#: Bits of a sieve: a table of two megabytes, whatever goes into it.
SIEVE_BITS = 1 << 24


def sieve(values: DataFrame, column: str) -> DataFrame:
    """A bitmap of hashes (longs), in rows of 4 KB, of a fixed size."""
    x = F.pmod(F.col(column), F.lit(SIEVE_BITS))
    return values.select(F.bitmap_bucket_number(x).alias("_bucket"), F.bitmap_bit_position(x).alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def sifted(rows: DataFrame, column: str, bitmap: DataFrame) -> DataFrame:
    """Rows whose hash may be in the bitmap: all that are, and few others as long as it is sparse. For the larger side of a join, before its shuffle."""
    x = F.pmod(F.col(column), F.lit(SIEVE_BITS))
    at = F.bitmap_bit_position(x).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, _at % 8) & 1") == 1
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(x)).join(F.broadcast(bitmap), "_bucket")
    return met.withColumns({"_byte": byte, "_at": at}).where(hit).drop("_bucket", "_bits", "_byte", "_at")


def packed(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns of docs (those of keep, if given) as one struct, so that none of their names can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])


def unpacked(rows: DataFrame, name: str) -> list[Column]:
    """The columns of a packed struct, by their own names."""
    return [F.col(name).getField(f.name).alias(f.name) for f in rows.schema[name].dataType]


def with_row(row: DataType, more: str) -> StructType:
    """The schema of a packed row and further fields."""
    return StructType([StructField("row", row), *StructType.fromDDL(more)])


def texts(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: its own column, or where there is none that of the packed row."""
    return batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("row"), "text")


def with_text(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(row) with the columns keep, and (text) if it is none of them."""
    return docs.select(packed(docs, keep).alias("row"), *(() if "text" in keep else ("text",)))


def pieces(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch's texts with at most so many bytes each (a longer text stands alone), so that only one range at a time becomes Python objects."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        n = n or 0
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, len(column)
