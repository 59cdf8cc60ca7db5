"""Sharding over fixed virtual slots.

Records are hashed into a fixed number of virtual slots; bytes and rows are added up for each slot; a
versioned map says which shard holds which slot; a map that exists is edited into its next version. The first version deals slots, heaviest first, to the
shard with the fewest bytes. A rebalance edits the latest version and moves as few slots as it needs.
All of it is DataFrame operations; what is gathered in one place is the map, at most ``slots`` rows.

Law: ``bytes`` (shard sizes are near equal). Defined results: a null text has no bytes (size 1); rows
with a null doc_id are hashed by their text; rows that repeat a doc_id fall into one slot; an empty table
gives an empty result and an even map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import numbered
from .common import files_of, load, new_path, written

SLOTS = 4096


def slot_of(doc_id, text, slots: int):
    key = F.when(doc_id.isNull(), F.xxhash64(F.coalesce(text, F.lit("")))).otherwise(F.xxhash64(doc_id))
    return F.pmod(key, F.lit(slots)).cast("int")


def slot_sizes(rows: DataFrame, slots: int) -> DataFrame:
    """(vslot, bytes, n) for every slot, also those without rows."""
    spark = rows.sparkSession
    held = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(held, "vslot", "left").fillna(0, ["bytes", "n"])


class SlotMap:
    """Versions of the slot-to-shard map: Parquet rows (version, vslot, shard, bytes) below ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "slot-map")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={version}")

    def latest(self) -> int | None:
        """The newest version that is wholly written."""
        found = [int(f.rsplit("/", 2)[1].split("=")[1]) for f in files_of(self.spark, f"{self.path}/version=*/_SUCCESS")]
        return max(found, default=None)

    def _store(self, version: int, df: DataFrame) -> DataFrame:
        """Versions are never written over; only what a lost job left half-written is."""
        if version in {int(f.rsplit("/", 2)[1].split("=")[1]) for f in files_of(self.spark, f"{self.path}/version=*/_SUCCESS")}:
            raise ValueError(f"version {version} of the slot map exists")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return self.read(version)

    def current(self, sizes: DataFrame, shards: int) -> DataFrame:
        """The map for rows of these sizes: the latest version edited into a new one, or the first version."""
        base = self.latest()
        return self.build(sizes, shards) if base is None else self.rebalance(sizes, shards, base)

    def build(self, sizes: DataFrame, shards: int, version: int = 0) -> DataFrame:
        """Heaviest slot first, each to the shard that has the fewest bytes so far."""
        return self._store(version, _dealt(sizes, shards, start=f"array_repeat(CAST(0 AS BIGINT), {shards})"))

    def rebalance(self, sizes: DataFrame, shards: int, base: int, tolerance: float = 0.01) -> DataFrame:
        """Version ``base + 1``: slots stay where they are while their shard holds at most its fair share.

        In each shard slots are kept, lightest first (so few are moved), up to ``(1 + tolerance)`` times the mean; the others, and
        all slots of shards that are gone, are dealt again to the emptiest shards.
        """
        old = self.read(base).select("vslot", F.col("shard").alias("_was"))
        now = sizes.join(old, "vslot", "left")
        mean = now.agg((F.sum("bytes") / shards).alias("_mean"))
        w = Window.partitionBy("_was").orderBy("bytes", "vslot")
        now = now.crossJoin(F.broadcast(mean)).withColumn("_sum", F.sum("bytes").over(w))
        stays = (F.col("_was") < shards) & (F.col("_sum") <= F.col("_mean") * (1 + tolerance))
        now = now.withColumn("_keep", F.when(F.coalesce(stays, F.lit(False)), F.col("_was")))
        kept = now.filter("_keep IS NOT NULL").select("vslot", "bytes", "n", F.col("_keep").alias("shard"))
        held = kept.groupBy("shard").agg(F.sum("bytes").alias("b"))
        loads = held.agg(F.map_from_entries(F.collect_list(F.struct("shard", "b"))).alias("_held"))
        moved = now.filter("_keep IS NULL").select("vslot", "bytes", "n")
        start = f"transform(sequence(0, {shards - 1}), s -> coalesce(element_at(_held, s), CAST(0 AS BIGINT)))"
        return self._store(base + 1, kept.unionByName(_dealt(moved, shards, start, loads)))


def _dealt(sizes: DataFrame, shards: int, start: str, loads: DataFrame | None = None) -> DataFrame:
    """Greedy dealing as one fold over the sorted slots; ``start`` gives the bytes that shards hold already."""
    order = sizes.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("neg"), "vslot", "n"))).alias("s"))
    if loads is not None:
        order = order.crossJoin(F.broadcast(loads))
    fold = f"""aggregate(s,
        named_struct('held', {start}, 'out', CAST(array() AS ARRAY<STRUCT<vslot: INT, bytes: BIGINT, n: BIGINT, shard: INT>>)),
        (acc, x) -> named_struct(
            'held', transform(acc.held, (b, i) ->
                IF(i = CAST(array_position(acc.held, array_min(acc.held)) - 1 AS INT), b - x.neg, b)),
            'out', concat(acc.out, array(named_struct('vslot', x.vslot, 'bytes', -x.neg, 'n', x.n,
                'shard', CAST(array_position(acc.held, array_min(acc.held)) - 1 AS INT))))),
        acc -> acc.out)"""
    return order.select(F.explode(F.expr(fold)).alias("x")).select("x.vslot", "x.bytes", "x.n", "x.shard")


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS, slot_map: SlotMap | None = None) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law, shard, slot (its place in the shard), grown_shard, vslot."""
    spark = docs.sparkSession
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text")
    rows = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(doc_id, text, slots).alias("vslot"),
    )
    rows = written(rows, "shard-rows")
    slot_map = slot_map or SlotMap(spark)
    placed = slot_map.current(slot_sizes(rows, slots), shards)
    # Places: rows before a slot in its shard, then the rank inside the slot. At most `slots` rows are summed up.
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("vslot")) - F.col("n")
    offsets = placed.select("vslot", "shard", before.alias("_before"))
    # A doc_id that a third of all rows repeat fills one slot; numbers by ranges do not need it in one task.
    return (
        numbered(rows, ["vslot"], ["doc_id", "text_crc32", "size"], "_nth")
        .join(F.broadcast(offsets), "vslot")  # at most `slots` rows
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_nth") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "vslot",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(load(spark, sf_dir, "documents"))
