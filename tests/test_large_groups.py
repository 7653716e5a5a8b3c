"""Evidence of popular pairs, of publications with very many keywords, and of odd scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from litloom.functions import scoring
from litloom.operators import evidence

COOC = "pmid string, type1 string, type2 string, keywordId1 string, keywordId2 string, evidence_score double, text string, isMapped boolean"


def plain(scores):
    return math.fsum(s / k**2 for k, s in enumerate(sorted(scores, reverse=True), 1))


def test_tails_and_sums_of_any_count(spark):
    counts = [0, 1, 2, 63, 64, 65, 1000, 46_340, 46_341, 3_000_000]
    df = spark.createDataFrame([(n,) for n in counts], "n long")
    got = {r[0]: r[1:] for r in df.select("n", scoring.harmonic_repeat(F.lit(2.0), F.col("n")), scoring.max_harmonic(F.col("n"))).collect()}
    for n in counts:
        assert got[n] == (pytest.approx(2 * math.fsum(1 / k**2 for k in range(1, n + 1)), rel=1e-14), pytest.approx(math.fsum(1 / k for k in range(1, n + 1)), rel=1e-13))
    far = spark.range(1).select(scoring.harmonic_repeat(F.lit(1.0), F.lit(10**12)), scoring.harmonic_repeat(F.lit(1.0), F.lit(None).cast("long"))).collect()[0]
    assert far[0] == pytest.approx(math.pi**2 / 6 - 1e-12, abs=1e-15) and far[1] is None


def test_an_array_beyond_the_root_of_an_int(spark):
    got = spark.range(1).select(scoring.harmonic(F.array_repeat(F.lit(0.5), 50_000))).collect()[0][0]
    assert got == pytest.approx(plain([0.5] * 50_000), rel=1e-12)


def test_runs_equal_the_array(spark):
    rng = random.Random(5)
    rows = [(g, rng.choice([None, 0.0, -0.5, 0.1, 0.25, 3.0, rng.random()]), rng.randint(1, 3)) for g in range(40) for _ in range(rng.randint(1, 200))]
    rows += [(99, None, 2), (100, -1.0, 1)]
    got = {r.g: r.h for r in scoring.harmonic_sums(spark.createDataFrame(rows, "g int, s double, n int"), ["g"], "s", "n", "h").collect()}
    for g in got:
        own = [s for h, s, n in rows if h == g and s is not None for _ in range(n)]
        assert got[g] == (pytest.approx(plain(own), rel=1e-12, abs=1e-12) if own else None)


def test_a_pair_with_very_many_rows(spark):
    n = 10_000_000
    rows = spark.range(n).select(
        (F.col("id") % 1000).cast("string").alias("pmid"), F.lit("GP").alias("type1"), F.lit("DS").alias("type2"), F.lit("G").alias("keywordId1"), F.lit("E").alias("keywordId2"),
        (F.col("id") % 10 + 1).cast("double").alias("evidence_score"), F.lit("t").alias("text"), F.lit(True).alias("isMapped"),
    )
    (got,) = evidence.evidence_from_cooccurrences(rows).collect()
    tail = lambda k: math.fsum([1 / (k + 0.5), -1 / (12 * (k + 0.5) ** 3)]) if k else math.pi**2 / 6
    want = sum((10 - i) / 10 * (tail(i * n // 10) - tail((i + 1) * n // 10)) for i in range(10))
    assert got.harmonicCooccurrenceSentiment == pytest.approx(want, rel=1e-12) and got.cooccurredPublicationCount == 1000


def test_cooccurrences_are_read_once(spark):
    rows = [(str(i % 7), "GP", "DS", f"G{i % 3}", f"E{i % 2}", float(i % 5) if i % 4 else None, "t" * (590 + i % 20), i % 6 > 0) for i in range(300)] + [(None, "GP", "DS", "G9", "E9", None, "", True)]
    coocs = spark.createDataFrame(rows, COOC)
    df = evidence.evidence_from_cooccurrences(coocs)
    got = {tuple(r[:2]): (r[2], r[3]) for r in df.collect()}
    own = {}
    for p, _, _, a, b, s, t, m in rows:
        if m and len(t) < 600:
            own.setdefault((a, b), []).append((p, s))
    assert got.keys() == own.keys()
    for k, v in own.items():
        scores = [s / 10 for _, s in v if s is not None]
        assert got[k] == (pytest.approx(plain(scores)) if scores else None, len({p for p, _ in v if p is not None}))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1


@pytest.mark.parametrize("block", [3, 1000])
def test_pairs_of_split_publications(spark, block):
    rng = random.Random(1)
    rows = [(str(p), rng.choice(["GP", "DS", "CD"]), f"K{k}", rng.randint(1, 4)) for p in range(12) for k in rng.sample(range(40), rng.randint(0, 40))]
    rows += [("hot", t, f"{t}{k}", 1) for t in ("GP", "DS") for k in range(37)] + [("one", "GP", f"K{k}", 2) for k in range(9)]
    got = sorted(tuple(r) for r in evidence.keyword_pairs(spark.createDataFrame(rows, "pmid string, type string, keywordId string, f int"), block).collect())
    want = sorted((p, a, b, f, g) for p, t, a, f in rows if t == "GP" for q, u, b, g in rows if q == p and u == "DS" and a != b)
    assert got == want


def test_a_publication_with_very_many_keywords_is_shared_out(spark):
    rows = spark.range(8000).select(F.lit("p").alias("pmid"), F.when(F.col("id") % 2 == 0, "GP").otherwise("DS").alias("type"), F.concat(F.lit("K"), F.col("id").cast("string")).alias("keywordId"), F.lit(1).alias("f"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        by_task = evidence.keyword_pairs(rows, 500).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    made = sorted(r["count"] for r in by_task)
    assert sum(made) == 4000 * 4000 and len(made) > 20 and made[-1] <= 20 * made[len(made) // 2]
