"""Helpers shared by the corpus operators."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fishladder
from fishladder.session import work_folder

# A side of a join is broadcast only after its rows and bytes were counted and
# found below these bounds; otherwise the join shuffles (AQE splits skewed keys).
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute URI of ``path`` as Spark resolves it (``file:///...``, ``hdfs://...``)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = str(fs.makeQualified(p).toString())
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of ``spark.checkpoint.dir``, as a URI."""
    return qualified(spark, work_folder(spark, name))


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the reread table (cuts the lineage)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows and, written
    as JSON, at most ``limit_bytes`` bytes, else unchanged.

    Pass written tables: they are read once more, beyond ``limit`` rows only their metadata.
    """
    if df.count() > limit:
        return df
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= limit_bytes else df


def join_counted(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join with ``side`` (written; one row per key, ``n`` counts the key's ``rows``).

    Keys with over a thousandth of all ``total`` rows, fewer than 1,000 of them,
    are broadcast, so that no key fills a task; the other keys are shuffled.
    """
    hot = F.broadcast(side.where(F.col("n") * 1000 > total).drop("n"))
    cold = side.where(F.col("n") * 1000 <= total).drop("n")
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Arrow batches of few rows (texts may be long), and this package on the
    executors' Python path, once per application, by way of the shared folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package, archive = Path(fishladder.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    target = f"{work_dir(spark, 'workers')}/fishladder_workers.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(archive.getvalue())
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def packed(df: DataFrame, name: str = "_row"):
    """All columns of ``df`` in one struct, so that no column name can clash
    with an operator's own (``select("_row.*")`` unpacks them)."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
