"""Posts that keep coming: files are read as they arrive, each post counts once, and weeks close with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import sampling

POSTS = "ord bigint, post_id string, source_type string, source string, thread string, parent_id string, role string, kind string, headline boolean, promotional boolean, score int, person string, time timestamp, text string"


def read(spark: SparkSession, folder: str, schema: str = POSTS, late: str = "7 days") -> DataFrame:
    """Posts of JSON-lines files that are put into a folder; a post that is delivered again within ``late`` is dropped."""
    rows = spark.readStream.schema(schema).json(folder)
    return rows.withWatermark("time", late).dropDuplicatesWithinWatermark(["post_id"])


def weekly(posts: DataFrame, width: str = "7 days") -> DataFrame:
    """(start, source, posts, eligible) of each period and source; rows come out when the watermark has passed a period."""
    framed = sampling.frame(posts)
    counts = framed.groupBy(F.window("time", width), "source").agg(F.count(F.lit(1)).alias("posts"), F.count_if(F.col("left_out").isNull()).alias("eligible"))
    return counts.select(F.col("window.start").alias("start"), "source", "posts", "eligible")


def redraw(posts: DataFrame, kept: str, out: str, seed: int, checkpoint: str) -> StreamingQuery:
    """Keep every post below ``kept`` and draw the sample again after each delivery, below ``out``.

    The draw is by hash, so growth changes little of it; a delivery that is repeated after a failure overwrites its own part.
    """

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():  # a step of the watermark alone
            return
        spark = batch.sparkSession
        batch.withColumn("delivery", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(kept)
        pool = sampling.frame(spark.read.parquet(kept).drop("delivery")).filter("left_out IS NULL")
        sampling.measurement_sample(pool, seed).write.mode("overwrite").parquet(f"{out}/delivery={number}")

    return posts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
