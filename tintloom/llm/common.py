"""What the operators of this subpackage share: tables on shared storage, and word scanning."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word of the contracts that split on ASCII white space, as a pattern of Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a batch that goes to a Python worker.
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class _Tables(threading.local):
    """Paths of the stored tables of a thread that exist, in the order they were made."""

    def __init__(self):
        self.paths: list[str] = []


_tables = _Tables()


def shared_folder(spark: SparkSession) -> str:
    """URI of the folder that all machines share: spark.checkpoint.dir, or, in local mode only, one of our own where unset."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("tintloom.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="tintloom-")
        spark.conf.set("tintloom.shared.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as a table on shared storage and read back: lineage ends here, sizes are known."""
    path = new_path(frame.sparkSession, name)
    _tables.paths.append(path)
    frame.write.parquet(path)
    read = frame.sparkSession.read.schema(frame.schema).parquet(path)
    read._stored_at = path
    return read


def _delete(spark: SparkSession, path: str) -> None:
    if path in _tables.paths:
        _tables.paths.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(*frames: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more; what was made of them is stored itself."""
    for frame in frames:
        _delete(frame.sparkSession, frame._stored_at)


def made() -> int:
    """A mark for discard_since."""
    return len(_tables.paths)


def discard_since(kept: DataFrame, mark: int) -> None:
    """Deletes all stored tables made after a mark but `kept`: for callers that have stored what they read."""
    for path in _tables.paths[mark:]:
        if path != kept._stored_at:
            _delete(kept.sparkSession, path)


def numbered(frame: DataFrame, order: list[str], ties: list[str], name: str) -> DataFrame:
    """A stored frame with the place 0, 1, ... of each row in the order of `order` and then `ties`; rows are dealt by ranges of `order`."""
    count = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.repartitionByRange(count, *order).sortWithinPartitions(*order, *ties)
    placed = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that are out of use."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Limits the bytes that Spark hands to a Python worker at once; the default of 64 MB is much for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], size: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column `size` holds about `most` bytes in each piece; a single long row stays whole."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(size))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
