"""Skip-gram vectors: the same in any cut, near for words that share bags, and stored with their settings."""

import random
import time
from dataclasses import replace

import numpy as np
import pytest

from litloom.config import Word2VecSettings
from litloom.operators import skipgram

SMALL = Word2VecSettings(vector_size=16, num_partitions=6, max_iter=2)


def _bags(n=900, topics=5, seed=4):
    rng = random.Random(seed)
    return [([f"t{t}w{rng.randint(0, 7)}" for _ in range(rng.randint(2, 12))],) for t in (rng.randrange(topics) for _ in range(n))]


def _vectors(model):
    return {r.word: (r["count"], tuple(r.vector)) for r in model.vectors.collect()}


def _fit(spark, rows, settings=SMALL):
    return skipgram.fit_skipgram(spark.createDataFrame(rows, "terms array<string>"), settings)


def test_the_same_vectors_for_any_number_of_tasks(spark):
    rows = _bags()
    rows += rows[:50]
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks in (1, 4, 16):
            random.Random(tasks).shuffle(rows)
            spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
            found.append(_vectors(skipgram.fit_skipgram(spark.createDataFrame(rows, "terms array<string>").repartition(tasks), SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) == 40
    assert found[0] != _vectors(_fit(spark, rows, replace(SMALL, seed=1)))


def test_words_of_one_topic_are_near(spark):
    got = {w: np.array(v) for w, (_, v) in _vectors(_fit(spark, _bags(3000), replace(SMALL, max_iter=6, step_size=0.05))).items()}
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    same = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[:2] == b[:2]]
    other = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[:2] != b[:2]]
    assert np.mean(same) > np.mean(other) + 0.3
    assert all(max((unit[a] @ unit[b], b) for b in unit if b != a)[1][:2] == a[:2] for a in unit)


def test_saved_and_loaded(spark, tmp_path):
    model = _fit(spark, _bags(100), replace(SMALL, max_iter=1))
    model.save(f"{tmp_path}/model")
    again = skipgram.SkipGramModel.load(spark, f"{tmp_path}/model")
    assert _vectors(again) == _vectors(model) and again.settings == model.settings
    with pytest.raises(Exception, match="already exists"):
        model.save(f"{tmp_path}/model")


def test_odd_bags_and_bounds(spark, monkeypatch):
    rows = [(None,), ([],), (["a"],), (["a", None, "b", "b"],), (["a", "c"],), (["b"] * 30,)]
    got = _vectors(_fit(spark, rows, replace(SMALL, min_count=2, max_sentence_length=7)))
    assert {w: n for w, (n, _) in got.items()} == {"a": 3, "b": 32}
    assert _vectors(_fit(spark, [(None,)])) == {}
    monkeypatch.setattr(skipgram, "MAX_CELLS", 31)
    with pytest.raises(ValueError, match="min_count"):
        _fit(spark, rows, replace(SMALL, min_count=2))


def test_every_token_is_learnt():
    shard = skipgram.Shard((np.zeros((50, 4)), np.zeros((50, 4))), np.arange(1, 51) / 50, SMALL, 0, 0, 200)
    for i in range(100):
        shard.add(np.array([i % 50, (i + 1) % 50]))
    shard.learn()
    assert shard.learnt[0].sum() == 200 and (shard.learnt[0] == 4).all() and shard.seen == 200


def test_rows_are_added_at_once():
    r = np.random.default_rng(0)
    at, factor, rows = r.integers(0, 150, (1024, 6)), r.random((1024, 6)), r.random((1024, 100))
    got, truth, shard = np.zeros((150, 100)), np.zeros((150, 100)), skipgram.Shard((np.zeros((150, 100)),) * 2, np.arange(1, 151) / 150, Word2VecSettings(), 0, 0, 1000)
    skipgram.add_rows(got, at, factor, rows)

    def seconds(f):
        times = []
        for _ in range(5):
            start = time.process_time()
            f()
            times.append(time.process_time() - start)
        return min(times)

    one_by_one = seconds(lambda: np.add.at(truth, at, factor[:, :, None] * rows[:, None, :]))
    assert np.allclose(got * 5, truth) and seconds(lambda: shard._step(at[:, 0], at[:, 1], 0.02)) < one_by_one
