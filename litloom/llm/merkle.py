"""Merkle manifest of a dataset: a tree of SHA-256 digests for each group of rows, a tree over the groups, and proofs.

Digests of rows are sorted by range; counts of the groups in each partition give every row its place in its group. A
partition then packs the aligned blocks of FANOUT ** height leaves that lie in it; what its bounds cut through is shuffled
by block. The blocks' roots are the leaves of a tree again, packed by block in the same way, until each group has one.
A block holds its rows, so a proof takes the siblings in the block and those of the blocks above, the same for all its rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litloom.llm.runtime import forget, ship, staged

FANOUT = 16
#: Levels of a block: 4,096 leaves, some 300 kB with their digests.
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"
#: Rows of one Arrow batch of proofs, which take some 5 kB each.
PROOFS = 512


def leaf_digest(fields: Mapping[str, Column] | None = None) -> Column:
    """SHA-256, 32 bytes, of a row's FIELDS in this order: `-` for null, else the bytes' number, a colon and the value.

    fields replaces the named ones.
    """

    def said(c: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*(said((fields or {}).get(c, F.col(f"`{c}`"))) for c in FIELDS)), 256))


def levels(nodes: list[bytes], least: int = 0) -> list[list[bytes]]:
    """nodes (hex digests) and the levels above, up to one node and over `least` levels: runs of FANOUT become one node."""
    out = [nodes]
    while len(out[-1]) > 1 or len(out) <= least:
        last = out[-1]
        out.append([sha256(b"".join(last[i : i + FANOUT])).hexdigest().encode() for i in range(0, len(last), FANOUT)])
    return out


def _block_levels(rows: pa.Array, n: int, height: int) -> list[list[bytes]]:
    """The levels in a block, given its rows and the number of leaves in the whole tree."""
    return levels([x.hex().encode() for x in rows.field("node").to_pylist()], height if n > FANOUT**height else 0)


def _placed(leaves: DataFrame, *order: str) -> DataFrame:
    """leaves (grp, order, ...) sorted by range, with idx, their place in grp, and n, the size of grp; and to be read in order.

    A range is a file, in which rows keep their order, so what a file needs to know is how many rows of its groups lie in
    the files before. Of a group there is one row for each file with rows of it.
    """
    sorted_ = staged(leaves.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).withColumn("part", F.spark_partition_id()), "leaves")
    at = sorted_.withColumn("at", F.col("_metadata.row_index"))
    by_grp = W.partitionBy("grp")
    counts = at.groupBy("part", "grp").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    offsets = counts.select(
        "part", "grp", "first",
        F.coalesce(F.sum("here").over(by_grp.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("here").over(by_grp).alias("n"),
    )
    placed = at.join(offsets, ["part", "grp"]).withColumn("idx", F.col("before") + F.col("at") - F.col("first"))
    return placed.drop("part", "at", "first", "before").sortWithinPartitions("grp", "idx")


def _pieces(placed: DataFrame, height: int) -> DataFrame:
    """Rows of one block that lie together in a partition, as one row: grp, block, n, at (the first one's idx), rows.

    rows holds all columns but grp and n. Only the rows of the block being read are held.
    """
    own = [f for f in placed.schema.fields if f.name not in ("grp", "n")]
    names, size = [f.name for f in own], FANOUT**height

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        key = n = None

        def piece() -> pa.RecordBatch:
            rows = pa.concat_arrays(held)
            parts = [[key[0]], [key[1]], [n], [rows.field("idx")[0].as_py()], pa.ListArray.from_arrays([0, len(rows)], rows)]
            return pa.RecordBatch.from_arrays([pa.array(p) if isinstance(p, list) else p for p in parts], ["grp", "block", "n", "at", "rows"])

        for batch in batches:
            if not batch.num_rows:
                continue
            grp, block = batch["grp"].to_numpy(zero_copy_only=False), batch["idx"].to_numpy(zero_copy_only=False) // size
            rows = pa.StructArray.from_arrays([batch[c] for c in names], names)
            cuts = np.flatnonzero((grp[1:] != grp[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(grp)], strict=True):
                if held and key != (grp[a], int(block[a])):
                    yield piece()
                    held = []
                key, n = (grp[a], int(block[a])), batch["n"][int(a)].as_py()
                held.append(rows.slice(a, b - a))
        if held:
            yield piece()

    schema = T.StructType([T.StructField("grp", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("block", "n", "at")), T.StructField("rows", T.ArrayType(T.StructType(own)))])
    return placed.mapInArrow(pack, schema)


def _blocks(pieces: DataFrame, height: int) -> DataFrame:
    """grp, block, n, rows, digest of each block: pieces that are whole blocks stay where they are, others meet by block."""
    size = FANOUT**height
    pieces = staged(pieces, "pieces")
    whole = F.size("rows") == F.least(F.lit(size), F.col("n") - F.col("block") * size)
    ragged = pieces.filter(~whole).groupBy("grp", "block").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "rows"))).alias("parts"))
    met = pieces.filter(whole).select("grp", "block", "n", "rows").union(ragged.select("grp", "block", "n", F.flatten("parts.rows").alias("rows")))

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bytes.fromhex(_block_levels(batch["rows"][i].values, batch["n"][i].as_py(), height)[-1][0].decode()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "digest"])

    out = staged(met.mapInArrow(roots, T.StructType([*met.schema.fields, T.StructField("digest", T.BinaryType())])), "blocks")
    forget(pieces)
    return out


def _tops(blocks: DataFrame, height: int) -> DataFrame:
    """grp, block, path from the block's root to its tree's, and that one (top, hex)."""
    nodes = blocks.select("grp", F.col("block").alias("idx"), F.expr(f"(n + {FANOUT**height - 1}) div {FANOUT**height}").alias("n"), F.col("digest").alias("node"))
    if nodes.filter("n > 1").isEmpty():
        return nodes.select("grp", F.col("idx").alias("block"), F.array().cast(PATH).alias("path"), F.lower(F.hex("node")).alias("top"))
    # One node for each block, met by the block of nodes it lies in.
    met = nodes.withColumn("block", F.expr(f"idx div {FANOUT**height}")).groupBy("grp", "block").agg(F.max("n").alias("n"), F.min("idx").alias("at"), F.array_sort(F.collect_list(F.struct("idx", "node"))).alias("rows"))
    above = _blocks(met, height)
    return _opened(above, _tops(above, height), height).withColumnRenamed("idx", "block").drop("node")


def _opened(blocks: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """grp, the columns of rows, path and the columns of above but path: rows of blocks, with their proofs.

    above: grp, block, path, and columns that are the same for all rows of a block.
    """
    more = [f for f in above.schema.fields if f.name not in ("grp", "block", "path")]
    own = blocks.schema["rows"].dataType.elementType.fields
    joined = blocks.drop("digest").join(above, ["grp", "block"])
    side = pa.struct([("left", pa.string()), ("right", pa.string())])

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch["rows"][k].values
                tree = _block_levels(rows, batch["n"][k].as_py(), height)[:-1]
                top = [(s["left"], s["right"]) for s in batch["path"][k].as_py()]
                for a in range(0, len(rows), PROOFS):
                    some = rows.slice(a, PROOFS)
                    lefts, rights = [], []
                    for i in range(a, a + len(some)):
                        for nodes in tree:
                            run = i // FANOUT * FANOUT
                            lefts.append(b"".join(nodes[run:i]))
                            rights.append(b"".join(nodes[i + 1 : run + FANOUT]))
                            i //= FANOUT
                        lefts.extend(s[0] for s in top)
                        rights.extend(s[1] for s in top)
                    sides = pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (lefts, rights)], fields=list(side))
                    path = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype="int32") * (len(tree) + len(top))), sides)
                    same = [pa.array([batch[f.name][k].as_py()] * len(some), batch.schema.field(f.name).type) for f in more]
                    fields = [some.field(f.name) for f in own]
                    yield pa.RecordBatch.from_arrays([pa.array([batch["grp"][k].as_py()] * len(some), pa.string()), *fields, path, *same], ["grp", *(f.name for f in own), "path", *(f.name for f in more)])

    path_type = above.schema["path"].dataType
    return joined.mapInArrow(opened, T.StructType([T.StructField("grp", T.StringType()), *own, T.StructField("path", path_type), *more]))


def merkle_proofs(docs: DataFrame, carry: Mapping[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """doc_id, source, leaf, position (in the source, from 0), path, subroot, root of each row, and what carry computes of it.

    leaf, subroot and root are lowercase hex. path lists, from the leaf upwards through its source's tree and the tree of
    sources, what stands left and right of the node in its run, as hex digests end to end; `folded` gives the root again.
    Leaves of a source ascend by doc_id, null first, then by leaf; equal rows are equal leaves, each with its own place. A
    null source is a group of its own, the first one. Null fields and empty texts are told apart. An empty table has no rows
    and no root. Columns besides FIELDS are ignored; carry's names must not be those of the result. Nothing but one row for
    each block of 16 ** height leaves is ever gathered above the blocks, and no group in one task.
    """
    ship(docs.sparkSession)
    extra = {f"_carried_{i}": c for i, c in enumerate((carry or {}).values())}
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("node"), *(c.alias(n) for n, c in extra.items()))
    blocks = _blocks(_pieces(_placed(leaves, "doc_id", "node"), height), height)
    above = _tops(blocks, height)
    # The sources' roots, in the order of their names, are the leaves of one tree more.
    subroots = above.filter("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.unhex("top").alias("node"))
    sources = _blocks(_pieces(_placed(subroots, "name"), height), height)
    roots = _opened(sources, _tops(sources, height), height).select(F.col("name").alias("grp"), F.col("path").alias("more"), F.col("top").alias("root"))
    upper = above.join(roots, "grp").select("grp", "block", F.concat("path", "more").alias("path"), F.col("top").alias("subroot"), "root")
    out = _opened(blocks, upper, height)
    source = F.when(F.col("grp") != "", F.substring("grp", 2, 2**31 - 1))
    return out.select("doc_id", source.alias("source"), F.lower(F.hex("node")).alias("leaf"), F.col("idx").alias("position"), "path", "subroot", "root", *(F.col(n).alias(c) for n, c in zip(extra, carry or {}, strict=True)))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give, all lowercase hex."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def tampered_text() -> Column:
    """text in lower-case (A-Z) in rows that 5 divides the CRC-32 of whose doc_id in decimals; null doc_ids: unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def merkle_digest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Each row's proof, held against what tampered_text makes of the row."""
    changed = F.lower(F.hex(leaf_digest({"text": tampered_text()})))
    proofs = merkle_proofs(docs, {"changed": changed}, height)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    found = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.col("changed"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
