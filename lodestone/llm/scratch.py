"""Written intermediate tables, in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where that is unset, a temporary folder if driver and executors are one
    process (local tests), else an error: no other machine would see it."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if sc.applicationId not in _own:
            _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        root = _own[sc.applicationId]
    return root.rstrip("/") + "/lodestone"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path string."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: lineage ends here, and a lost executor costs
    a reread instead of a recomputation. The files go when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame, part: str = "") -> None:
    """Delete a table that saved() gave, or a part of it such as "kind=1", once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if not path.endswith(part):
            continue
        fs, p = hadoop_path(df.sparkSession, path)
        fs.delete(p, True)


def lookup(rows: DataFrame, table: DataFrame, key: str, fill: str, most: int = 100_000) -> DataFrame:
    """rows joined with table (one row a key, no nulls, written before), where `fill` says how many rows each key has.

    Keys with more than a `most`-th of all rows are at most `most` and are sent to every executor; the others are
    joined by shuffle, where no key has more rows than that share. So no task gets a hot key's rows."""
    share = (table.agg(F.sum(fill)).first()[0] or 0) / most
    heavy = table.filter(F.col(fill) > max(share, 1000.0))
    if not heavy.limit(1).count():
        return rows.join(table, key)
    mark = heavy.select(F.col(key).alias("__heavy"))
    light = rows.join(F.broadcast(mark), F.col(key) == F.col("__heavy"), "left_anti")
    return light.join(table.filter(F.col(fill) <= max(share, 1000.0)), key).unionByName(rows.join(F.broadcast(heavy), key))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to any more."""
    for _ in range(2):  # the first frees the plans, the second what only they held
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
