"""Schemas of the inputs, and of the evidence that comes out."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

_string, _long, _double, _int = StringType(), LongType(), DoubleType(), IntegerType()


def _fields(**of: DataType) -> StructType:
    return StructType([StructField(name.replace("__", "-"), kind) for name, kind in of.items()])


_strings = ArrayType(_string)
_labels = ArrayType(_fields(label=_string))

EPMC_IDS = _fields(PMID=_string, PMCID=_string)
MATCH = _fields(label=_string, type=_string, startInSentence=_long, endInSentence=_long, sectionStart=_long, sectionEnd=_long)
COOCCURRENCE = _fields(label1=_string, label2=_string, type=_string, start1=_long, end1=_long, start2=_long, end2=_long, sentEvidenceScore=_double)
SENTENCE = _fields(section=_string, text=_string, matches=ArrayType(MATCH), co__occurrence=ArrayType(COOCCURRENCE))
PUBLICATIONS = _fields(pmid=_string, pmcid=_string, pubDate=_string, organisms=_strings, sentences=ArrayType(SENTENCE))
DISEASES = _fields(id=_string, name=_string, synonyms=_fields(hasExactSynonym=_strings, hasNarrowSynonym=_strings, hasBroadSynonym=_strings, hasRelatedSynonym=_strings))
TARGETS = _fields(
    id=_string, approvedName=_string, approvedSymbol=_string, symbolSynonyms=_labels, nameSynonyms=_labels, obsoleteSymbols=_labels, obsoleteNames=_labels, proteinIds=ArrayType(_fields(id=_string))
)
DRUGS = _fields(id=_string, name=_string, tradeNames=_strings, synonyms=_strings)
EVIDENCE = _fields(
    targetFromSourceId=_string, diseaseFromSourceMappedId=_string, datasourceId=_string, datatypeId=_string, resourceScore=_double, similarity=_double, harmonicSimilarity=_double,
    sharedPublicationCount=_int, meanTargetFreqPerPub=_double, meanDiseaseFreqPerPub=_double, harmonicCooccurrenceSentiment=_double, cooccurredPublicationCount=_long,
)
