"""Tables written in the folder that the cluster shares, to cut lineage without losing it with an executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where that is unset and all tasks run on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master or 'the cluster'} share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="colloq-"))
    return _OWN[0]


def written(df: DataFrame, what: str) -> DataFrame:
    path = f"{shared_root(df.sparkSession)}/{what}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """A column ``name`` with each row's number in its group, from 1, without a group in one task.

    Rows are dealt by ranges of (group, order), so a large group spans several partitions; numbers are the rank in the
    partition and the rows of the group in the partitions before, one sum a partition and group.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = written(df.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_before", F.sum("_size").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_size"))
    rank = F.row_number().over(Window.partitionBy("_part", *group).orderBy(*order))
    out = dealt.withColumn("_rank", rank).join(sizes.drop("_size"), ["_part", *group])
    return out.withColumn(name, F.col("_rank") + F.col("_before")).drop("_part", "_rank", "_before")
