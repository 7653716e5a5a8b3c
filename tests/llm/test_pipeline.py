"""The stages of the corpus pipeline, each against a plain version on its own input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from litloom.llm import jaccard, mix, pack, resample, runtime, substring
from litloom.llm.runtime import staged
from tests.llm.test_operators import LABELS, SCHEMA, frame, plain_cut, plain_features, plain_weights, prose


def plain_drawn(spark, docs, labels):
    """The doc_ids that importance resampling draws, by counts of plain n-grams, and how far each one's key lies from the
    least one drawn; ids are distinct and not null."""
    from collections import Counter

    texts = {r.doc_id: r.text or "" for r in docs}
    features = {i: plain_features(t) for i, t in texts.items()}
    kind = {}
    for r in labels:
        if r.doc_id in texts and r.doc_id is not None:
            good = 1 if r.quality == 1 and not r.toxic else 0 if r.quality == 0 or r.toxic == 1 else None
            if good is not None:
                kind[r.doc_id] = min(good, kind.get(r.doc_id, 1))
    good = [i for i, g in kind.items() if g]
    weight = plain_weights(features, good)
    whole = {i: sum(weight[f] for f in fs) for i, fs in features.items()}
    cut = plain_cut(spark, features, good, [i for i, g in kind.items() if not g])
    hashed = {r.i: r.h for r in spark.createDataFrame([(i, len(fs)) for i, fs in features.items()], "i long, n long").select("i", F.xxhash64("i", "n", F.lit(5)).alias("h")).collect()}
    key = {i: whole[i] - np.log(-np.log((hashed[i] % 2**52 + 0.5) / 2**52)) for i, fs in features.items() if fs}
    drawn = sorted(key, key=key.get, reverse=True)[: sum(whole[i] >= cut for i in key)]
    return set(drawn), {i: abs(k - key[drawn[-1]]) for i, k in key.items()}


def plain_targets(sizes):
    """Each source's target: shares by weights 1, 2, 3, repeating, of all sizes, at most three times a source's size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in order if s not in full))
        new = {s for s in order if s not in full and level * weight[s] > 3 * sizes[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= new


def words(text):
    return (text or "").encode().split()


def is_part(part, whole):
    """Whether the words of part are in whole, in their order."""
    rest = iter(whole)
    return all(w in rest for w in part)


def check_stages(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = staged(stage(spark, docs, sf_dir), name)
        rows = out.collect()
        if name != "pack_sequences":
            assert out.columns == docs.columns
        if name == "quality_classifier":
            drawn, off = plain_drawn(spark, before, labels.collect())
            other = drawn ^ {r.doc_id for r in rows}  # as some n-grams share a bucket
            assert len(other) <= 0.05 * len(before) and all(off[i] < 1 for i in other)
        elif name == "jaccard_join":
            truth = jaccard.brute_force([(r.doc_id, r.text) for r in before])
            assert sorted(r.doc_id for r in rows) == sorted(i for i, (n, c) in truth.items() if c == i)
        elif name == "substring_dedup":
            truth = dict(zip((r.doc_id for r in before), substring.brute_force([r.text for r in before]), strict=True))
            assert {r.doc_id: len(words(r.text)) for r in rows} == {i: n - gone for i, (n, gone, _) in truth.items()}
        elif name == "mix_sources":
            whole = {r.doc_id: r for r in before}
            sizes, taken, each = {}, {}, {}
            for r in before:
                sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
            for r in rows:
                taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
                each[r.doc_id] = each.get(r.doc_id, 0) + len(words(r.text))
                assert r.source == whole[r.doc_id].source and is_part(words(r.text), words(whole[r.doc_id].text))
            assert all(n <= 3 * len(words(whole[i].text)) for i, n in each.items())
            for s, target in plain_targets(sizes).items():
                assert abs(taken.get(s, 0) - target) <= 0.02 * target + 2
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(pack.default_tokenizer())
            wanted = sorted((str(r.doc_id), [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in before)
            made, held = [], []
            for r in sorted(rows, key=lambda r: r.sequence_id & (2**59 - 1)):  # in the order of the scan
                if r.start == 0:
                    held = []
                    made.append((str(r.doc_id), held))
                held += np.frombuffer(bytes(r.ids), "<u4").tolist()
            assert sorted(made) == wanted
        docs = out


def test_stages(spark, sf_dir):
    check_stages(spark, sf_dir, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_run_is_what_the_stages_make(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = runtime.staged_tables(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    made = sorted(map(str, docs.select(columns).collect()))
    assert made and sorted(map(str, corpus_pipeline.run(spark, sf_dir).select(columns).collect())) == made
    runtime.release(spark, before)
    assert runtime.staged_tables(spark) == before


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Documents with null and repeated ids, null and empty texts, ties, repeated rows and columns of clashing names."""
    r = random.Random(3)
    rows = [(i, prose(60 + i % 7, i), r.choice(["a", "b", None])) for i in range(150)]
    rows += [(None, prose(70, 900 + i), "a") for i in range(5)] + [(None, None, None), (None, "", "a"), (3, prose(60, 1000), "b"), (3, prose(60, 1000), "b"), (4, None, "a"), (5, " \n ", None)]
    rows += [(200 + i, prose(80, 7), None) for i in range(6)] + [(300, prose(4000, 8), "a")]
    path = tmp_path_factory.mktemp("odd")
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), int(i % 9 == 0)) for i in range(0, 150, 2)] + [(None, 1, 0), (3, None, 1), (3, 1, 0)], LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_on_odd_documents(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = staged(stage(spark, docs, odd_dir), name)
        rows = out.collect()
        if name == "pack_sequences":
            assert sum(r.start == 0 for r in rows) == len(before) and len({r.sequence_id for r in rows}) == len(rows)
            break
        assert out.columns == docs.columns and rows
        if name in ("quality_classifier", "jaccard_join"):  # whole rows stay or go
            kept = [str(r) for r in rows]
            assert all(kept.count(x) <= [str(r) for r in before].count(x) for x in set(kept))
        docs = out


def test_stages_on_an_empty_table(spark, odd_dir):
    docs = staged(spark.createDataFrame([], SCHEMA), "none")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, odd_dir), name)
        assert docs.count() == 0


def test_stages_without_labels(spark, odd_dir, tmp_path):
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    name, stage = corpus_pipeline.STAGES[0]
    kept = stage(spark, docs, str(tmp_path)).collect()
    assert len(kept) == sum(bool(words(r.text)) for r in docs.collect())
