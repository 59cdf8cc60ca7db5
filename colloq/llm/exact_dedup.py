"""Exact deduplication with a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. New data is reduced to one row a
digest, deduplicated against the index by a sort-merge anti-join that reads the index without a shuffle,
and what is new is appended. Everything is DataFrame operations.

Defined results: a null text counts as the empty text; a null doc_id is smaller than any other; rows that
repeat both doc_id and text are one record delivered several times (each is marked like the others, and
``keep_rows`` returns one of them); an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, dropped, fits, load, new_path, own, tidy, written

LEAST_BUCKETS = 32
ROW_BYTES = 160  # of a (doc_id, digest) in a hash table
SCHEMA = "digest binary, keep_id bigint, n bigint, generation int"


def digest_of(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far, with the doc_id that stands for each.

    ``path`` names the index; opening an existing path continues it, with the buckets it was made with. A new index has as many
    buckets as there are shuffle partitions, ``LEAST_BUCKETS`` at least, so that its files grow with the cluster.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or new_path(spark, "digest-index")
        self.buckets = self._settled(buckets or max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.table} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.generation = spark.table(self.table).agg(F.coalesce(F.max("generation") + 1, F.lit(0))).first()[0]

    def _settled(self, buckets: int) -> int:
        """The number of buckets that a mark in the folder names; without one, ``buckets``, which is marked then."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        marks = files.globStatus(path(f"{self.path}/_buckets_*"))
        if marks:
            return int(marks[0].getPath().getName().rsplit("_", 1)[1])
        files.create(path(f"{self.path}/_buckets_{buckets}")).close()
        return buckets

    def close(self) -> None:
        """Forget the table's name in this session; the files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, batch: DataFrame) -> None:
        """``batch`` (doc_id, digest): append the digests that the index lacks. Repeating a batch adds nothing."""
        groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        with tidy(self.spark):
            rows = fresh.withColumn("generation", F.lit(self.generation)).repartition(self.buckets, "digest").sortWithinPartitions("digest")
            writer = rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            writer.option("path", self.path).saveAsTable(self.table)
        self.generation += 1


def _digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(F.col("text")).alias("digest"))


def index_all(docs: DataFrame, batches: int = 2, buckets: int | None = None) -> tuple[DataFrame, DigestIndex]:
    """Digest every document and load an index in ``batches`` ranges of doc_id, largest ids first.

    The first row of a text to reach the index stands for it, so that order makes the largest doc_id stay. The ranges are
    cut at quantiles, so gaps between ids do not make them uneven.
    """
    spark = docs.sparkSession
    slim = written(_digests(docs), "digests")
    cuts = [k / batches for k in range(1, batches)]
    edges = [None, *(slim.agg(F.percentile_approx("doc_id", cuts)).first()[0] or [] if cuts else []), None]
    index = DigestIndex(spark, buckets=buckets)
    doc_id = F.col("doc_id")
    for lo, hi in reversed(list(zip(edges, edges[1:], strict=False))):
        above = F.lit(True) if lo is None else F.coalesce(doc_id > lo, F.lit(False))
        below = F.lit(True) if hi is None else doc_id.isNull() | (doc_id <= hi)
        index.ingest(slim.filter(above & below))
    return slim, index


def _copies(slim: DataFrame, index: DigestIndex) -> DataFrame:
    """``slim`` with keep_id and group_size; both are null where no other row has the text."""
    sizes = slim.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return attach(slim, sizes.join(index.rows().select("digest", "keep_id"), "digest"), "digest", ["doc_id"])


def exact_dedup(docs: DataFrame, batches: int = 2, buckets: int | None = None) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    slim, index = index_all(docs, batches, buckets)
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return _copies(slim, index).select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_rows(docs: DataFrame, batches: int = 1, buckets: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    Only digests are grouped and sorted. The texts meet the list of the rows that go, which is sent to the tasks if its size
    allows it and else joined by hash; records delivered several times, if any, are all that is made distinct with their texts.
    """
    slim, index = index_all(docs, batches, buckets)
    copies = _copies(slim, index).filter("group_size > 1")
    go = copies.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "digest", F.lit(False).alias("twice"))
    twice = copies.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    listed = go.distinct().unionByName(twice.filter("n > 1").select("doc_id", "digest", F.lit(True).alias("twice")))
    listed = written(listed.select(F.col("doc_id").alias("_cq_id"), F.col("digest").alias("_cq_digest"), "twice"), "copies")
    index.close()
    dropped(slim)
    n, many = listed.agg(F.count(F.lit(1)), F.count_if("twice")).first()
    rows = docs.withColumns({"_cq_own": F.col("doc_id").cast("bigint"), "_cq_hash": digest_of(F.col("text"))})
    same = F.col("_cq_own").eqNullSafe(F.col("_cq_id")) & (F.col("_cq_hash") == F.col("_cq_digest"))
    place = lambda t: F.broadcast(t) if fits(n, ROW_BYTES) else t.hint("shuffle_hash")
    stay = rows.join(place(listed), same, "left_anti")
    if many:
        again = rows.join(place(listed.filter("twice")), same, "left_semi").dropDuplicates(["_cq_own", "_cq_hash"])
        stay = stay.unionByName(again)
    return stay.select(own(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(load(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
