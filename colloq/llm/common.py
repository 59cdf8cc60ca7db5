"""Helpers shared by the training-data operators: shared folder, written tables, skew-safe look-ups."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []

#: Larger tables are shuffled instead of being sent to all tasks.
BROADCAST_BYTES = 32 << 20


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a temporary folder is made if all tasks run on this
    machine, as in tests; on a cluster nothing local will do, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master or 'the cluster'} share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="colloq-"))
    return _OWN_FOLDER[0]


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs at most the tasks of one later stage, and everything that
    reads the table sees the same rows.
    """
    spark = df.sparkSession
    path = new_path(spark, what)
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        if df is not None:
            drop_folder(df.sparkSession, df.written_path)


def drop_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def files_of(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(at)
    return sorted(x.getPath().toString() for x in found or [])


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is written here removes its own shuffle files when it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trim(spark: SparkSession) -> None:
    """Let the driver's JVM give back what ended jobs held; for once a stage, ahead of its largest plans."""
    spark._jvm.System.gc()


def fits(rows: int, row_bytes: int) -> bool:
    """Whether a table of so many rows, of at most so many bytes each, may be sent to every task."""
    return rows * row_bytes <= BROADCAST_BYTES


def salt_of(columns: list[Column], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def attach(rows: DataFrame, facts: DataFrame, key: str, spread: list[str], salts: int = 16) -> DataFrame:
    """Left join of ``rows`` with ``facts`` (one row a key), safe against a key with a third of all rows.

    Rows of a key are dealt over ``salts`` partitions by a hash of the columns ``spread``; every fact is
    repeated ``salts`` times. Callers keep ``facts`` to keys that occur more than once.
    """
    salted = rows.withColumn("_salt", salt_of([F.col(c) for c in spread], salts))
    copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def own(docs: DataFrame) -> list[Column]:
    """The columns of a table, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
