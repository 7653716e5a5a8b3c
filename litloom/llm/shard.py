"""Sharding: contiguous shards of near equal bytes, from prefix sums of per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litloom.llm.runtime import all_columns, as_scan, staged, with_row_key


def shard_sizes(docs: DataFrame) -> DataFrame:
    """rid, did, doc_id, size (UTF-8 bytes of the text and 8; null: 8) and text_crc32 of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return with_row_key(docs, "doc_id", "text").select("rid", "did", "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def assign_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """A shard and a gapless slot in it for each row, in the order of (doc_id, row key), nulls first.

    A row goes to the shard in which its first byte lies when all sizes are laid end to end and the whole is
    cut into n_shards equal lengths; shards differ from the mean by one row's size at most. Only sizes are
    dealt into ranges, never texts. A repeated row or id is a row of its own; ranges split between the rows
    of one id. Null and empty texts have size 8. An empty table gives an empty result. Other columns of
    docs are ignored.
    """
    order = ("doc_id", "rid")
    sizes = staged(shard_sizes(docs), "sizes")
    ranged = staged(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    # One row for each partition, so the one task that adds them up stays small.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    bases = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base_rows"),
        F.sum("bytes").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"),
    )
    within = W.partitionBy("part").orderBy(*order)
    laid = (
        ranged.withColumns({"upto": F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)), "nth": F.row_number().over(within)})
        .join(bases, "part")
        .withColumn("shard", F.expr(f"cast(least((base_bytes + upto - size) * {n_shards} div total, {n_shards - 1}) as int)"))
        .withColumn("at", F.col("base_rows") + F.col("nth") - 1)
        .select("rid", "did", "doc_id", "size", "text_crc32", "shard", "at")
    )
    first = laid.groupBy("shard").agg(F.min("at").alias("first_at"))  # n_shards rows at most
    return laid.join(F.broadcast(first), "shard").select("rid", "did", "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first_at")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24) -> DataFrame:
    """docs written under path as one folder `shard=N` for each shard; returns the assignment.

    The shards' first keys, n_shards rows, are all that is sent around; each row finds its shard by them.
    """
    docs = as_scan(docs)
    assigned = staged(assign_shards(docs, n_shards), "shards")
    firsts = assigned.filter("slot = 0").select("shard", F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "rid").orderBy("shard").collect()
    rows, names = all_columns(docs)
    key = F.struct(F.coalesce(F.col(names["doc_id"]).cast("long"), F.lit(-(2**63))).alias("k"), F.col("rid"))
    shard = F.lit(firsts[0].shard if firsts else 0)
    for row in firsts[1:]:
        shard = F.when(key >= F.struct(F.lit(row.k).cast("long").alias("k"), F.lit(row.rid).alias("rid")), F.lit(row.shard)).otherwise(shard)
    own = {c: n for c, n in names.items() if c.lower() != "shard"}  # the folders' name is taken
    rows.select(*(F.col(n).alias(c) for c, n in own.items()), shard.alias("shard")).write.partitionBy("shard").parquet(path)
    return assigned


def shard_digest(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The assignment under the law `bytes`; grown_shard is null, as that law does not use it."""
    return assign_shards(docs, n_shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
