import datetime
import json

import pytest

from litloom.operators import embedding, evidence, index, skipgram

MATCH = "pmid string, pmcid string, date date, year int, month int, day int, section string, type string, keywordId string, label string, startInSentence long, endInSentence long, isMapped boolean"
DAY = datetime.date(2020, 1, 2)


def matches(spark, rows):
    return spark.createDataFrame([(p, None, DAY, 2020, 1, 2, s, t, k, k.lower(), 0, 1, m) for p, s, t, k, m in rows], MATCH)


def test_relevance(spark):
    rows = [("1", "title", "DS", "K", True), ("1", "title", "DS", "K", True), ("1", "abstract", "DS", "K", True), ("1", "abstract", "DS", "K", True), ("1", "results", "DS", "K", True), ("2", "nowhere", "DS", "K", True), ("2", "title", "DS", "K", False)]
    df = index.mapped(matches(spark, rows))
    best = {r.pmid: r.relevance for r in index.relevance(df).collect()}
    assert best["1"] == pytest.approx(1 + 0.8 / 4 + 0.8 / 9) and best["2"] == pytest.approx(0.01)  # a title counts once
    assert {r.pmid: r.relevance for r in index.relevance(df, "all").collect()}["1"] == pytest.approx(1 + 0.8 / 4 + 0.8 / 9 + 0.6 / 16)
    with pytest.raises(ValueError):
        index.relevance(df, "some")


def test_literature_index(spark):
    rows = [("1", "title", "DS", "K", True), ("1", "methods", "GP", "G", True), ("PPR1", "title", "DS", "K", True)]
    got = {r.keywordId: r for r in index.literature_index(matches(spark, rows)).collect()}
    assert got["K"].pmid == 1 and got["K"].year == 2020 and got["G"].relevance == pytest.approx(0.3) and len(got) == 2
    assert json.loads(got["G"].sentences)[0]["section"] == "title" and json.loads(got["G"].sentences)[0]["matches"][0]["keywordId"] == "K"


def test_publication_index(spark):
    rows = [("1", "title", "DS", "K", True), ("1", "title", "DS", "K", True), ("1", "methods", "GP", "G", True), ("2", None, "DS", "K", True)]
    got = index.publication_index(matches(spark, rows)).collect()
    assert [(r.pmid, [tuple(c) for c in r.countsPerTerm], r.terms, len(r.sentences[0].matches)) for r in got] == [("1", [("G", 1), ("K", 2)], ["G", "K"], 1)]


def test_bags_and_model(spark):
    rows = [("1", "title", "DS", "EFO_1", True), ("1", "abstract", "GP", "ENSG1", True), ("1", "results", "GP", "ENSG1", True), ("1", "x", "CD", "CHEMBL1", True), ("2", "title", "ZZ", "Z", True)]
    bags = embedding.training_bags(matches(spark, rows))
    assert sorted(r.terms for r in bags.collect()) == [["EFO_1", "ENSG1"], ["EFO_1", "ENSG1", "ENSG1"], ["ENSG1"]]
    one, two = ([tuple(r) for r in embedding.vector_table(skipgram.fit_skipgram(bags).vectors).orderBy("word").collect()] for _ in range(2))
    assert one == two and {r.word for r in embedding.model_vectors(embedding.fit_word2vec(bags)).collect()} == {r[1] for r in one}
    assert [r[0] for r in one] == ["disease", "target"] and len(one[0][3]) == 100


def test_evidence(spark):
    rows = [("1", "title", "DS", "E", True), ("1", "abstract", "DS", "E", True), ("1", "title", "GP", "G", True), ("2", "title", "DS", "E", True), ("2", "title", "GP", "G", True), ("2", "unlisted", "GP", "G", True)]
    vectors = spark.createDataFrame([("E", [1.0, 0.0]), ("G", [1.0, 1.0])], "word string, vector array<double>")
    coocs = [(p, "GP", "DS", "G", "E", s, "x" * n, True) for p, s, n in (("1", 5.0, 599), ("1", 10.0, 10), ("2", 10.0, 600))]
    coocs = spark.createDataFrame(coocs, "pmid string, type1 string, type2 string, keywordId1 string, keywordId2 string, evidence_score double, text string, isMapped boolean")
    (got,) = evidence.generate_evidence(matches(spark, rows), coocs, vectors).collect()
    cos = 1 / 2**0.5
    assert (got.sharedPublicationCount, got.meanDiseaseFreqPerPub, got.meanTargetFreqPerPub) == (2, 1.5, 1.0)
    assert got.similarity == pytest.approx(cos) and got.resourceScore == got.harmonicSimilarity == pytest.approx(cos * 1.25)
    assert got.harmonicCooccurrenceSentiment == pytest.approx(1 + 0.5 / 4) and got.cooccurredPublicationCount == 1
    assert evidence.generate_evidence(matches(spark, rows), coocs, vectors, threshold=0.9).count() == 0
