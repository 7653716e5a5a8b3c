import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litloom.functions import scoring, text
from litloom.functions.porter import stem_tokens, with_stems
from tests.plain_porter import porter_stem


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_keys(spark):
    labels = ["IFN-γ", "IL-2", "THE cat", "the the cat", "TNF-α", "don't stop", "!!!", "a i", "beta/alpha beta", None]
    rows = spark.createDataFrame([(x,) for x in labels], "label string").select(
        "label", text.word_key(text.word_tokens(text.transliterate(F.col("label")))).alias("lt"), text.symbol_key(text.symbol_tokens(text.transliterate(F.col("label")))).alias("tt")
    )
    got = {r.label: (r.lt, r.tt) for r in rows.collect()}
    assert got["IFN-γ"] == ("gifn", "ifng") and got["IL-2"] == ("2il", "il2")
    assert got["THE cat"] == ("catthe", "thecat")  # stop words are compared as they stand
    assert got["the the cat"] == ("cat", "thethecat") and got["TNF-α"] == ("tnf", "tnfa")
    assert got["don't stop"] == ("stop", "dontstop") and got["!!!"] == (None, None) and got["a i"] == (None, "ai")
    assert got["beta/alpha beta"] == ("alphabeta", "betaalphabeta") and got[None] == (None, None)


@pytest.mark.parametrize(("word", "stem"), [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"), ("vietnamization", "vietnam"), ("triplicate", "triplic"), ("hopefulness", "hope"), ("goodness", "good"), ("revival", "reviv"), ("replacement", "replac"), ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"), ("roll", "roll"), ("diseases", "diseas"), ("is", "is"), ("été", "été")])
def test_porter(word, stem):
    assert porter_stem(word) == stem


def test_stems_as_columns(spark):
    rng = random.Random(11)
    parts = "y a e i o u yy b bl s t l ll z ss at iz y ational tional enci izer abli alli entli eli ousli ization ation ator alism iveness fulness ousness aliti iviti biliti icate ative alize iciti ical ful ness al ance er ement ment ent ion sion tion ou ism ate iti ous ive ize ed eed ing s ies sses w x".split()
    words = {"".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(6000)} | {"caresses", "ponies", "agreed", "hopping", "sky", "rate", "controll", "is", "été", "", "il2", "yes", "yyed", "oed", "ing"}
    got = {r.token: r.stem for r in with_stems(spark.createDataFrame([(w,) for w in sorted(words)], "token string")).collect()}
    assert got == {w: porter_stem(w) for w in words}


def test_stems_of_rows(spark):
    rows = spark.createDataFrame([(1, ["running", "dogs", "running"]), (2, []), (3, None)], "k int, t array<string>")
    df = stem_tokens(rows, "t", ["k"])
    assert sorted(map(tuple, df.collect())) == [(1, ["run", "dog", "run"]), (2, []), (3, [])]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_stems_meet_where_their_row_is(spark, tmp_path):
    spark.createDataFrame([(1, ["running", "x9", "dogs", "running", "été"]), (2, ["x9", None, "cats"]), (3, None)], "k int, t array<string>").write.parquet(str(tmp_path / "t"))
    df = stem_tokens(spark.read.parquet(str(tmp_path / "t")), "t", ["k"])
    assert sorted(map(tuple, df.collect())) == [(1, ["run", "x9", "dog", "run", "été"]), (2, ["x9", "cat"]), (3, [])]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")  # dealt as whole rows
    shuffles = [x for x in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1


def test_harmonic(spark):
    got = values(spark, [([0.5, 0.5, 1.0],), ([],), (None,), ([0.3],)], "v array<double>", scoring.harmonic(F.col("v")), scoring.rank_discounted(F.col("v")))
    assert got[0][0] == pytest.approx(1 + 0.5 / 4 + 0.5 / 9) and got[0][1] == pytest.approx(0.5 + 0.5 / 4 + 1 / 9)
    assert got[1] == (None, None) and got[2] == (None, None) and got[3] == (pytest.approx(0.3),) * 2


def test_repeats_and_bounds(spark):
    got = values(spark, [(0.5, 3)], "s double, n int", scoring.harmonic_repeat(F.col("s"), F.col("n")), scoring.max_harmonic(F.col("n")))
    assert got[0] == (pytest.approx(0.5 * (1 + 1 / 4 + 1 / 9)), pytest.approx(1 + 1 / 2 + 1 / 3))


def test_cosine(spark):
    got = values(spark, [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>", scoring.cosine(F.col("a"), F.col("b")), scoring.l2_norm(F.col("a")))
    assert got == [(pytest.approx(24 / 25), 5.0), (0.0, 0.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=1, max_size=30))
def test_harmonic_is_bounded(spark, vs):
    got = values(spark, [(vs,)], "v array<double>", scoring.harmonic(F.col("v")))[0][0]
    assert max(vs) - 1e-12 <= got <= max(vs) * math.pi**2 / 6 + 1e-12
