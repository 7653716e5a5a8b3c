"""Evidence for target–disease pairs from matches and from co-occurrences."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litloom.config import SECTION_RANKS, SectionRank
from litloom.functions.scoring import cosine, harmonic_repeat, harmonic_sums
from litloom.operators.index import mapped, section_table
from litloom.operators.terms import DISEASE, TARGET

#: What evidence rows say of their source; the length that a sentence stays below; the scale of scores.
DATASOURCE, DATATYPE = "ew2v", "literature"
MAX_TEXT, SCORE_SCALE = 600, 10
#: Keywords of a side of one publication that a task pairs with as many of the other side; more are split into groups.
PAIR_BLOCK = 1000


def keyword_frequency(matches: DataFrame, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """pmid, type, keywordId, f: mapped hits in listed sections."""
    ranked = mapped(matches).join(F.broadcast(section_table(matches, ranks).select("section")), "section", "left_semi")
    return ranked.filter("pmid is not null").groupBy("pmid", "type", "keywordId").agg(F.count("*").alias("f"))


def keyword_pairs(counts: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """pmid, targetFromSourceId, diseaseFromSourceMappedId, ft, fd: every target and other keyword that is a disease of one
    publication, with their frequencies (counts: pmid, type, keywordId, f).

    A publication's targets and diseases are split into groups of about `block` by hash; each pair of groups is a key of the
    join, so that one with very many keywords is shared out, and no task pairs more than block by block of it. A side's
    rows are repeated once for each group of the other side, which is one for all but such publications.
    """
    here = W.partitionBy("pmid")
    sizes = {"__t": F.count_if(F.col("type") == TARGET).over(here), "__d": F.count_if(F.col("type") == DISEASE).over(here)}
    grouped = counts.filter(F.col("type").isin(TARGET, DISEASE)).withColumns(sizes).withColumns({c: F.expr(f"int(({c} + {block} - 1) div {block})") for c in sizes}).filter("__t > 0 and __d > 0")
    own = lambda groups: F.pmod(F.xxhash64("keywordId"), F.col(groups)).cast("int")
    every = lambda groups: F.explode(F.sequence(F.lit(0), F.col(groups) - 1))
    targets = grouped.filter(F.col("type") == TARGET).select("pmid", F.col("keywordId").alias("targetFromSourceId"), F.col("f").alias("ft"), own("__t").alias("__a"), every("__d").alias("__b"))
    diseases = grouped.filter(F.col("type") == DISEASE).select("pmid", F.col("keywordId").alias("diseaseFromSourceMappedId"), F.col("f").alias("fd"), every("__t").alias("__a"), own("__d").alias("__b"))
    # Dealt by number: few bytes may stand for very many pairs, so partitions aren't to be joined together by their bytes.
    keys = ["pmid", "__a", "__b"]
    dealt = targets.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    shared = dealt.join(diseases, keys).filter(F.col("targetFromSourceId") != F.col("diseaseFromSourceMappedId"))
    return shared.select("pmid", "targetFromSourceId", "diseaseFromSourceMappedId", "ft", "fd")


def evidence_from_matches(matches: DataFrame, vectors: DataFrame, threshold: float = 0.01, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """Pairs that share publications, with the similarity of their vectors (word, vector) above the threshold.

    Pairs are counted by their ids alone; the vectors join the pairs that are left.
    """
    words = vectors.select(F.col("word").alias("keywordId")).distinct()
    shared = keyword_pairs(keyword_frequency(matches, ranks).join(words, "keywordId", "left_semi"))
    pair = ["targetFromSourceId", "diseaseFromSourceMappedId"]
    pairs = shared.groupBy(*pair).agg(F.avg("ft").alias("meanTargetFreqPerPub"), F.avg("fd").alias("meanDiseaseFreqPerPub"), F.count("*").cast("int").alias("sharedPublicationCount"))
    double = F.col("vector").cast("array<double>")
    for side, name in zip(pair, ("vt", "vd"), strict=True):
        pairs = pairs.join(vectors.select(F.col("word").alias(side), double.alias(name)), side)
    near = pairs.withColumn("similarity", cosine(F.col("vt"), F.col("vd"))).filter(F.col("similarity") > threshold)
    score = harmonic_repeat(F.col("similarity"), F.col("sharedPublicationCount"))
    return near.select(
        *pair, F.lit(DATASOURCE).alias("datasourceId"), F.lit(DATATYPE).alias("datatypeId"), score.alias("resourceScore"), "similarity", score.alias("harmonicSimilarity"),
        "sharedPublicationCount", "meanTargetFreqPerPub", "meanDiseaseFreqPerPub",
    )


def evidence_from_cooccurrences(coocs: DataFrame) -> DataFrame:
    """Pairs of a target and a disease in sentences of under MAX_TEXT characters, with the harmonic sum of their scores.

    Rows are counted by pair, publication and score first; the sum and the number of publications both read that shuffle.
    """
    rows = coocs.filter(F.col("isMapped") & (F.col("type1") == TARGET) & (F.col("type2") == DISEASE) & (F.length("text") < MAX_TEXT))
    pair = ["targetFromSourceId", "diseaseFromSourceMappedId"]
    named = rows.select(F.col("keywordId1").alias(pair[0]), F.col("keywordId2").alias(pair[1]), "pmid", (F.col("evidence_score") / SCORE_SCALE).alias("score"))
    # Both read n, or the plans of the counts would differ, and the co-occurrences be read twice.
    counted = named.groupBy(*pair, "pmid", "score").agg(F.count("*").alias("n")).filter("n > 0")
    publications = counted.groupBy(*pair).agg(F.countDistinct("pmid").alias("cooccurredPublicationCount"))
    return harmonic_sums(counted, pair, "score", "n", "harmonicCooccurrenceSentiment").join(publications, pair)


def generate_evidence(matches: DataFrame, coocs: DataFrame, vectors: DataFrame, threshold: float = 0.01, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """Evidence from matches with what co-occurrences add, 0 where they add nothing."""
    joined = evidence_from_matches(matches, vectors, threshold, ranks).join(evidence_from_cooccurrences(coocs), ["targetFromSourceId", "diseaseFromSourceMappedId"], "left")
    return joined.fillna(0, ["harmonicCooccurrenceSentiment", "cooccurredPublicationCount"])
