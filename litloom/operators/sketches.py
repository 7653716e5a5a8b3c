"""How many keywords a key stands for, by sketches that are kept with each release of a catalogue and merged when read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.operators.terms import with_key

#: Log of a sketch's registers: counts are within 1 % in most cases; small sets are held exactly, in a few bytes.
LOG_REGISTERS = 15


def release_sketches(terms: DataFrame, catalogue: str, release: str, stem: bool = True, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """catalogue, release, type, labelN, sketch: of each key of a catalogue's terms, its keywords as a sketch."""
    keyed = with_key(terms, "text", stem=stem).filter("keywordId is not null")
    return keyed.groupBy(F.lit(catalogue).alias("catalogue"), F.lit(release).alias("release"), "type", "labelN").agg(F.hll_sketch_agg("keywordId", F.lit(log_registers)).alias("sketch"))


def with_release(stored: DataFrame, new: DataFrame) -> DataFrame:
    """stored sketches with those of a new release in place of its catalogue's; the other catalogues' aren't read again."""
    return stored.join(new.select("catalogue").distinct(), "catalogue", "left_anti").unionByName(new)


def merged_counts(sketches: DataFrame) -> DataFrame:
    """type, labelN, uniqueKeywordIdsPerLabelN over all catalogues: a keyword that several have counts once."""
    merged = sketches.groupBy("type", "labelN").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("type", "labelN", F.hll_sketch_estimate("sketch").alias("uniqueKeywordIdsPerLabelN"))


def sketched_lookup(parts: list[DataFrame], sketches: DataFrame, stem: bool = True) -> DataFrame:
    """As entity_lookup() of the parts' terms, with counts from the sketches kept of them."""
    rows = [with_key(p, "text", stem=stem).select("labelN", "type", "keywordId", "factor") for p in parts]
    return reduce(DataFrame.unionByName, rows).distinct().join(merged_counts(sketches), ["type", "labelN"]).select("labelN", "type", "keywordId", "factor", "uniqueKeywordIdsPerLabelN")
