"""Shared helpers: staged tables and row identity."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.session import ship_package as ship  # noqa: F401
from litloom.sources.staging import forget, path_exists, release, run_dir, staged, staged_bytes, staged_tables  # noqa: F401

#: A word is a maximal run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def as_scan(docs: DataFrame) -> DataFrame:
    """docs, if its rows are known by file and place in it; else staged, so that they are.

    An operator that names the rows of its input more than once does this first, so that the names agree.
    """
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        return staged(docs, "rows")


def with_row_key(docs: DataFrame, *columns: str | Column, key: str = "doc_id") -> DataFrame:
    """The columns and `rid`, `did`, which together name a row even where doc_id (key) is null or repeated.

    rid hashes the file and the row's index in it, which do not depend on how a scan is split, so every
    scan of the table finds the same keys; did is doc_id, 0 for null. What isn't a plain scan is staged first.
    """
    rid = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return as_scan(docs).select(*columns, rid.alias("rid"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("did"))


def all_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs by row key, its columns under names that clash with nothing, and these names by the columns' own."""
    names = {c: f"_column_{i}" for i, c in enumerate(docs.columns)}
    return with_row_key(docs, *(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key is among keys (rid, did), with all of their columns."""
    rows, names = all_columns(docs)
    return rows.join(keys.select("rid", "did"), ["rid", "did"], "left_semi").select(*(F.col(n).alias(c) for c, n in names.items()))


def smallest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of smallest key, a 64-bit hash; equal keys in the order of the other columns.

    A cut that about 2 n rows pass is taken first, from their number, so that not every partition sends n rows
    to one place; should too few pass, it is left out.
    """
    order = [key, *(c for c in df.columns if c != key)]
    total = df.count()
    if total > 4 * n:
        passed = df.filter(F.col(key) < -(2**63) + (2**64 * 2 * n) // total)
        if passed.count() >= n:
            df = passed
    return df.orderBy(*order).limit(n)
