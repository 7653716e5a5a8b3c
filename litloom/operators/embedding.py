"""Keyword embeddings: bags of keywords, Word2Vec over them, and the table of vectors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.config import SECTION_RANKS, SectionRank, Word2VecSettings
from litloom.functions.scoring import l2_norm
from litloom.operators.index import section_table
from litloom.operators.terms import DISEASE, DRUG, TARGET


def embeddable(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("isMapped") & F.col("type").isin(DISEASE, TARGET, DRUG))


def training_bags(matches: DataFrame, ranks: Iterable[SectionRank] = SECTION_RANKS) -> DataFrame:
    """pmid, terms: for each publication a bag of the distinct keywords of each rank of sections, and one of all ranks
    with what ranks share repeated. Bags are sorted; sections that aren't listed are left out."""
    ranked = embeddable(matches).join(F.broadcast(section_table(matches, ranks)), "section")
    by_rank = ranked.groupBy("pmid", "rank").agg(F.sort_array(F.collect_set("keywordId")).alias("keys"))
    lists = by_rank.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct("rank", "keys")))["keys"].alias("all"))
    return lists.select("pmid", F.explode(F.concat(F.col("all"), F.array(F.flatten("all")))).alias("terms"))


def fit_word2vec(bags: DataFrame, settings: Word2VecSettings = Word2VecSettings()) -> Word2VecModel:
    """The engine's Word2Vec over bags, whose vectors differ from run to run; skipgram.fit_skipgram gives the same ones."""
    estimator = Word2Vec(
        inputCol="terms", outputCol="vector", windowSize=settings.window_size, numPartitions=settings.num_partitions, maxIter=settings.max_iter, minCount=settings.min_count,
        stepSize=settings.step_size, vectorSize=settings.vector_size, maxSentenceLength=settings.max_sentence_length, seed=settings.seed,
    )
    return estimator.fit(bags)


def model_vectors(model: Word2VecModel) -> DataFrame:
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def category(word: Column) -> Column:
    return F.when(word.startswith("ENSG"), "target").when(word.startswith("CHEMBL"), "drug").otherwise("disease")


def vector_table(vectors: DataFrame) -> DataFrame:
    """category, word, norm, vector of (word, vector)."""
    double = F.col("vector").cast("array<double>")
    return vectors.select(category(F.col("word")).alias("category"), "word", l2_norm(double).alias("norm"), double.alias("vector"))
