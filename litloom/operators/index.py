"""The literature index: how relevant a publication is to a keyword, and where its title and abstract name one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.config import SECTION_RANKS, SectionRank
from litloom.functions.scoring import rank_discounted

#: Rank and weight of a section that isn't listed.
OTHER_RANK, OTHER_WEIGHT = 100, 0.01
HEAD = ("title", "abstract")


def section_table(df: DataFrame, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """section, rank, weight: a handful of rows, so joins broadcast it."""
    return df.sparkSession.createDataFrame([(r.section, r.rank, float(r.weight)) for r in ranks], "section string, rank bigint, weight double")


def mapped(rows: DataFrame) -> DataFrame:
    return rows.filter("isMapped")


def section_weights(matches: DataFrame, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """pmid, keywordId, section, rank, weight, hits: how often a section names a keyword; a title counts once."""
    hits = matches.groupBy("pmid", "keywordId", "section").agg(F.count("*").alias("n"))
    ranked = hits.join(F.broadcast(section_table(matches, ranks)), "section", "left").fillna({"rank": OTHER_RANK, "weight": OTHER_WEIGHT})
    return ranked.select("pmid", "keywordId", "section", "rank", "weight", F.when(F.col("section") == "title", 1).otherwise(F.col("n")).cast("long").alias("hits"))


def _hits(ranks: Iterable[SectionRank]) -> tuple[list[SectionRank], list[Column]]:
    """Sections in the order in which their hits count, the unlisted ones as one, and an aggregate with each one's hits.

    A title counts once; so each keyword of a publication is one row of counters, combined before it is shuffled.
    """
    listed = list(ranks)
    order = sorted([*listed, SectionRank("", OTHER_RANK, OTHER_WEIGHT)], key=lambda r: (r.rank, -r.weight, r.section))
    known = F.coalesce(F.col("section").isin([r.section for r in listed]), F.lit(False))
    hits = []
    for i, r in enumerate(order):
        n = F.count_if(~known if r.section == "" else F.col("section") == r.section)
        hits.append((F.least(n, F.lit(1)) if r.section == "title" else n).cast("int").alias(f"hits_{i}"))
    return order, hits


def _score(order: list[SectionRank], scope: str) -> Column:
    """The sum of weight / k**2 over a row's hits, in order."""
    best = F.least(*(F.when(F.col(f"hits_{i}") > 0, r.rank) for i, r in enumerate(order)))
    counts = [F.when(best == r.rank, F.col(f"hits_{i}")).otherwise(0) if scope == "best_rank" else F.col(f"hits_{i}") for i, r in enumerate(order)]
    return rank_discounted(F.flatten(F.array(*(F.array_repeat(F.lit(float(r.weight)), n) for r, n in zip(order, counts, strict=True)))))


def _scoped(scope: str) -> str:
    if scope not in ("best_rank", "all"):
        raise ValueError(f"scope is best_rank or all, not {scope!r}")
    return scope


def relevance(matches: DataFrame, scope: str = "best_rank", ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """pmid, keywordId, relevance: the sum of weight / k**2 over hits, k counted in the order of (rank, weight downwards, section).

    scope "best_rank" takes the sections of the keyword's best rank only, "all" takes every section. One shuffle.
    """
    order, hits = _hits(ranks)
    return matches.groupBy("pmid", "keywordId").agg(*hits).select("pmid", "keywordId", _score(order, _scoped(scope)).alias("relevance"))


MATCH_FIELDS = ("label", "keywordType", "keywordId", "startInSentence", "endInSentence", "sectionStart", "sectionEnd")


def head_sentences(matches: DataFrame) -> DataFrame:
    """pmid, sections: for title and abstract, a struct of the section and its matches, all in sorted order."""
    rows = matches.filter(F.col("section").isin(*HEAD))
    fields = [F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in MATCH_FIELDS]
    by_section = rows.groupBy("pmid", "section").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("matches"))
    return by_section.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct("section", "matches"))).alias("sections"))


def literature_index(matches: DataFrame, scope: str = "best_rank", ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """pmid (long), pmcid, date, year, month, day, keywordId, relevance, keywordType, sentences (JSON) of mapped matches.

    Rows whose pmid is no number are left out; of rows that differ in pmcid, date or type, the smallest value of each counts.
    """
    rows = mapped(matches).withColumn("pmid", F.col("pmid").try_cast("long")).filter("pmid is not null").withColumnRenamed("type", "keywordType")
    order, hits = _hits(ranks)
    dated = F.min(F.struct("date", "year", "month", "day")).alias("d")
    about = rows.groupBy("pmid", "keywordId").agg(F.min("pmcid").alias("pmcid"), dated, F.min("keywordType").alias("keywordType"), *hits)
    scored = about.select("pmid", "keywordId", "pmcid", "d.*", "keywordType", _score(order, _scoped(scope)).alias("relevance"))
    sentences = head_sentences(rows).select("pmid", F.to_json("sections").alias("sentences"))
    return scored.join(sentences, "pmid", "left").select("pmid", "pmcid", "date", "year", "month", "day", "keywordId", "relevance", "keywordType", "sentences")


def publication_terms(matches: DataFrame) -> DataFrame:
    """pmid, pmcid, pubDate, organisms, countsPerTerm, terms of each publication's mapped keywords, in sorted order."""
    rows = mapped(matches).filter("section is not null")
    some = lambda c: (F.min(c) if c in rows.columns else F.min(F.lit(None).cast("string"))).alias({"date": "pubDate"}.get(c, c))
    counts = rows.groupBy("pmid", "keywordId").agg(some("pmcid"), some("date"), some("organisms"), F.count("*").alias("countsPerKey"))
    pairs = F.sort_array(F.collect_list(F.struct("keywordId", "countsPerKey")))
    grouped = counts.groupBy("pmid").agg(F.min("pmcid").alias("pmcid"), F.min("pubDate").alias("pubDate"), F.min("organisms").alias("organisms"), pairs.alias("countsPerTerm"))
    return grouped.withColumn("terms", F.col("countsPerTerm.keywordId"))


PUBLICATION_FIELDS = ("endInSentence", "label", "sectionEnd", "sectionStart", "startInSentence", "type", "keywordId", "isMapped")


def publication_sentences(matches: DataFrame) -> DataFrame:
    """pmid, sentences: distinct mapped matches by title and abstract, in sorted order."""
    rows = mapped(matches).filter(F.col("section").isin(*HEAD))
    fields = [F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in PUBLICATION_FIELDS]
    by_section = rows.select("pmid", "section", F.struct(*fields).alias("match")).distinct().groupBy("pmid", "section").agg(F.sort_array(F.collect_list("match")).alias("matches"))
    return by_section.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct("section", "matches"))).alias("sentences"))


def publication_index(matches: DataFrame) -> DataFrame:
    return publication_terms(matches).join(publication_sentences(matches), "pmid", "left")
