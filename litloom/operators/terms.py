"""The entity lookup: terms of diseases, targets and drugs, as keys with a factor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litloom.functions.porter import with_stems
from litloom.functions.text import symbol_key, symbol_tokens, transliterate, word_key, word_tokens

DISEASE, TARGET, DRUG = "DS", "GP", "CD"
WORDS, SYMBOL = "LT", "TT"

#: For each catalogue, the fields that hold terms, their factors, and the kinds of key they get.
DISEASE_TERMS = (("name", 1.0, (WORDS,)), ("synonyms.hasExactSynonym", 0.999, (WORDS,)), ("synonyms.hasNarrowSynonym", 0.998, (WORDS,)), ("synonyms.hasBroadSynonym", 0.997, (WORDS,)), ("synonyms.hasRelatedSynonym", 0.996, (WORDS,)))
TARGET_TERMS = (
    ("approvedName", 1.0, (WORDS,)), ("approvedSymbol", 1.0, (SYMBOL,)), ("nameSynonyms.label", 0.999, (WORDS,)), ("symbolSynonyms.label", 0.999, (SYMBOL,)),
    ("proteinIds.id", 0.999, (SYMBOL,)), ("obsoleteNames.label", 0.998, (WORDS,)), ("obsoleteSymbols.label", 0.998, (SYMBOL,)),
)
DRUG_TERMS = (("name", 1.0, (WORDS, SYMBOL)), ("tradeNames", 0.999, (WORDS, SYMBOL)), ("synonyms", 0.999, (WORDS, SYMBOL)))
#: The kinds of key that a label of a type is looked up by.
KEY_TYPES = {DISEASE: (WORDS,), TARGET: (WORDS, SYMBOL), DRUG: (WORDS, SYMBOL)}


def scored(values: Column, factor: float, key_type: str) -> Column:
    """An array of terms, null as empty, as structs with factor and kind of key."""
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda t: F.struct(t.alias("text"), F.lit(factor).alias("factor"), F.lit(key_type).alias("keyType")))


def catalogue_terms(catalogue: DataFrame, entity: str, fields) -> DataFrame:
    """keywordId, type, text, factor, keyType of every term of a catalogue."""
    kind = dict(catalogue.dtypes)
    arrays = [scored(F.array(f) if kind.get(f) == "string" else F.col(f), factor, key) for f, factor, keys in fields for key in keys]
    term = F.explode(F.array_distinct(F.flatten(F.array(*arrays))))
    return catalogue.select(F.col("id").alias("keywordId"), F.lit(entity).alias("type"), term.alias("t")).select("keywordId", "type", "t.*").filter(F.length("text") > 0)


def all_terms(diseases: DataFrame, targets: DataFrame, drugs: DataFrame) -> DataFrame:
    parts = [catalogue_terms(diseases, DISEASE, DISEASE_TERMS), catalogue_terms(targets, TARGET, TARGET_TERMS), catalogue_terms(drugs, DRUG, DRUG_TERMS)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def word_keys(texts: DataFrame) -> DataFrame:
    """text, key of each distinct text (texts: text), by the stems of its words; texts without a word have no row."""
    tokens = texts.distinct().select("text", F.explode(F.array_distinct(word_tokens(F.col("text")))).alias("token"))
    stems = with_stems(tokens.select("token").distinct())
    return tokens.join(stems, "token").groupBy("text").agg(word_key(F.collect_set("stem")).alias("key"))


def with_key(df: DataFrame, text: str, key_type: str = "keyType", stem: bool = True) -> DataFrame:
    """df with labelN, the key of the text by its kind; rows whose key is empty go."""
    words, keyed = word_key(word_tokens(F.col(text))), df
    if stem:
        keys = word_keys(df.filter(F.col(key_type) == WORDS).select(F.col(text).alias("text")))
        keyed, words = df.join(keys.select(F.col("text").alias("__of"), F.col("key").alias("__words")), (F.col(text) == F.col("__of")) & (F.col(key_type) == WORDS), "left"), F.col("__words")
    key = F.when(F.col(key_type) == WORDS, words).when(F.col(key_type) == SYMBOL, symbol_key(symbol_tokens(F.col(text))))
    return keyed.withColumn("labelN", key).drop("__of", "__words").filter(F.col("labelN").isNotNull())


def _within_key():
    return W.partitionBy("type", "labelN")


def entity_lookup(terms: DataFrame, stem: bool = True, transliterate_terms: bool = False, approximate: bool = False) -> DataFrame:
    """labelN, type, keywordId, factor, distinct, and uniqueKeywordIdsPerLabelN: how many keywords a key stands for.

    Only publications' labels are transliterated, unless transliterate_terms says that terms are too.
    """
    if transliterate_terms:
        terms = terms.withColumn("text", transliterate(F.col("text")))
    # Terms are made distinct first, as catalogues repeat them and a key takes long to make; by the text's dependence on the
    # count, the filter of empty keys isn't moved before that.
    distinct = terms.groupBy("keywordId", "type", "text", "factor", "keyType").agg(F.count("*").alias("__n")).withColumn("text", F.when(F.col("__n") > 0, F.col("text")))
    keyed = with_key(distinct, "text", stem=stem).select("labelN", "type", "keywordId", "factor").distinct()
    # The number of distinct keywords is the largest rank among them; no row carries their set.
    nth = F.dense_rank().over(_within_key().orderBy(F.col("keywordId").asc_nulls_last()))
    count = F.approx_count_distinct("keywordId", 0.01) if approximate else F.max(F.when(F.col("keywordId").isNotNull(), F.col("__nth")).otherwise(0))
    return keyed.withColumn("__nth", nth).withColumn("uniqueKeywordIdsPerLabelN", count.over(_within_key()).cast("long")).select("labelN", "type", "keywordId", "factor", "uniqueKeywordIdsPerLabelN")


def best_terms(lookup: DataFrame) -> DataFrame:
    """The lookup's rows with the largest factor of their key, ties kept; ranked here, once, and not for every label.

    By the partitioning that the lookup was made with, so that it isn't shuffled again.
    """
    return lookup.withColumn("__best", F.max("factor").over(_within_key())).filter(F.col("factor") == F.col("__best")).drop("__best")
