"""A corpus pipeline of this subpackage's operators: draw, link, cut, mix, pack.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns the next one's docs. run() writes
what each returns to the shared folder, as Parquet, and reads it again for the next. Rows with null or repeated ids,
null and empty texts and columns of any name go through every stage; each stage's docstring says what comes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.llm import jaccard, mix, pack, resample, substring
from litloom.llm.runtime import all_columns, as_scan, release, staged, staged_tables


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the labelled ones, in `labels`, say what is wanted. Null, empty and
    blank texts are never drawn; rows with null ids are drawn by their text alone."""
    return resample.drawn_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; wordless ones all stay."""
    return jaccard.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of windows that occur more than once; a changed text has its words joined by
    one space, and the length of a changed text is its own."""
    docs = as_scan(docs)
    cut = substring.dedup_substrings(docs).filter("n_removed > 0").select("rid", "did", F.col("text").alias("cut"), F.lit(True).alias("changed"))
    rows, names = all_columns(docs)
    new = {"text": F.when(F.col("changed"), F.col("cut")).otherwise(F.col(names["text"]))}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col("changed"), F.char_length("cut").cast("long")).otherwise(F.col(names["n_chars"]))
    return rows.join(cut, ["rid", "did"], "left").select(*(new.get(c, F.col(n)).alias(c) for c, n in names.items()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at its sources' target weights: a row for each pass over a document, with the words it takes. A null
    source is a source of its own; texts without words are in no mix."""
    return mix.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences, one for each piece, with its ids. A null text is packed as an empty one."""
    return pack.packed_pieces(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: SQL can't say what a hashed model draws, nor byte-pair ids; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of documents. A stage's own tables go once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = staged_tables(spark)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        release(spark, before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
