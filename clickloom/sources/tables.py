"""Parquet, CSV and view sources and sinks, and staged tables in the cluster's shared checkpoint folder.

Every path may be any Hadoop file-system URI.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Bytes of stored feature rows that one task of a fit reads, and of a row group of them, which no two tasks share. Spark ML keeps such
# rows with an entry for each vector slot, up to some tens of times their size in the file.
FIT_SPLIT = 16 << 20
SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def deal_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Deals a scan by key over as many tasks as the session's ``clickloom.scan.partitions`` says; unset, it stays as it is.

    For files of one large row group, which Spark reads in one task. It is for the caller to say so, and no key-hashed
    sample or split depends on it.
    """
    partitions = df.sparkSession.conf.get("clickloom.scan.partitions", None)
    return df.repartition(int(partitions), *keys) if partitions else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@contextmanager
def fine_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in parts of at most ``FIT_SPLIT`` bytes by what is planned inside, such as the fit of a model."""
    before = spark.conf.get(SPLIT_SETTING)
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)(?:i?b)?", before.strip().lower()).groups()
    spark.conf.set(SPLIT_SETTING, str(min(FIT_SPLIT, int(number) << 10 * " kmgtp".index(unit or " "))))
    try:
        yield
    finally:
        spark.conf.set(SPLIT_SETTING, before)


def write_parquet(df: DataFrame, path: str, mode: str = "error", partition_by: tuple[str, ...] = (), row_group: int | None = None) -> None:
    writer = df.write.mode(mode)
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Adds the rows as one run to a Parquet folder partitioned by ``run_id``. A run written again, as by a retried driver, replaces
    itself and leaves the other runs alone."""
    rows = df.withColumn("run_id", F.lit(run_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All runs, or some by a filter on ``run_id``, which reads only theirs. ``schema`` is that of the rows."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "append", single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` sends all rows through one task: meant for reports and small samples."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header. Blank strings are read as '' and not as NULL, so that they stay a category of their own."""
    reader = spark.read.schema(schema).option("header", True)
    return reader.csv(path).na.fill("", [f.name for f in schema if isinstance(f.dataType, T.StringType)])


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local-mode session may fall back to a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="clickloom-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"


_staged: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes, at its end, all that was staged inside it, and other paths added to the list that it gives. What is to stay, or to be
    read later, is written elsewhere before."""
    _staged.append([])
    try:
        yield _staged[-1]
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _staged.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), keep: bool = False, row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor re-reads a file.

    With ``keep`` it outlives the innermost ``staging``, as a part of its result, and belongs to the one around it.
    """
    path = stage_path(df.sparkSession, name)
    owners = _staged[:-1] if keep else _staged
    for paths in owners[-1:]:
        paths.append(path)
    write_parquet(df, path, partition_by=partition_by, row_group=row_group)
    return df.sparkSession.read.schema(df.schema).parquet(path)
