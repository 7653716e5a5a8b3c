from pyspark.sql import functions as F

from litloom.operators import pruning, sketches

TERMS = "keywordId string, type string, text string, factor double, keyType string"


def _terms(spark, keywords, mark):
    """Keys of 1, 10, ... keywords, as many as come to `keywords` in all."""
    rows = spark.range(keywords).select(F.concat(F.lit(mark), F.col("id").cast("string")).alias("keywordId"), F.lit("DS").alias("type"), F.concat(F.lit("key"), F.length(F.col("id").cast("string")).cast("string")).alias("text"), F.lit(1.0).alias("factor"), F.lit("LT").alias("keyType"))
    return rows


def test_merged_sketches_are_near_a_full_count(spark):
    a, b, c = _terms(spark, 60_000, "A"), _terms(spark, 120_000, "A"), _terms(spark, 30_000, "C")
    stored = sketches.release_sketches(a, "one", "1", stem=False).unionByName(sketches.release_sketches(c, "two", "1", stem=False))
    now = sketches.with_release(stored, sketches.release_sketches(b, "one", "2", stem=False))
    got = {r.labelN: r.uniqueKeywordIdsPerLabelN for r in sketches.merged_counts(now).collect()}
    exact = {r.text: r.n for r in b.union(c).groupBy("text").agg(F.countDistinct("keywordId").alias("n")).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - exact[k]) <= max(0, 0.01 * exact[k]) for k in exact)
    assert {(r.catalogue, r.release) for r in now.collect()} == {("one", "2"), ("two", "1")}
    # what both releases have counts once
    both = sketches.merged_counts(stored.unionByName(sketches.release_sketches(b, "one", "2", stem=False)))
    assert all(abs(r.uniqueKeywordIdsPerLabelN - exact[r.labelN]) <= 0.01 * exact[r.labelN] for r in both.collect())


def test_a_filter_keeps_all_partners_and_few_others(spark, monkeypatch):
    keys = spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("t"))
    rows = spark.range(120_000).select(F.col("id").cast("string").alias("k"), F.lit("t").alias("t"), (F.col("id") % 3).alias("rest"))
    made = pruning.key_filter(keys, ["t", "k"])
    kept = pruning.may_match(rows, made, ["t", "k"])
    assert kept.columns == rows.columns
    left = {int(r.k) for r in kept.collect()}
    assert set(range(0, 60_000, 3)) <= left and len(left) < 20_000 + 0.1 * 100_000
    assert pruning.may_match(rows.limit(50), pruning.key_filter(keys.limit(0), ["t", "k"]), ["t", "k"]).count() == 0
    monkeypatch.setattr(pruning, "MAX_FILTER_BYTES", 100)
    assert pruning.key_filter(keys, ["t", "k"]) is None and pruning.may_match(rows, None, ["t", "k"]) is rows
