"""Skip-gram vectors that are the same however the work is cut: training dealt by content, weights averaged as integers.

Bags are dealt to shards by a hash of their words, and ordered in a shard by the words themselves. In each round a shard
learns by itself from the round's first weights, with a generator seeded by round and shard. Its weights, as whole
numbers weighed by how often a word was learnt, are summed over the shards of a task and then over tasks; such sums don't
depend on their order, so neither the number of tasks nor a repeated one shows in the result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litloom.config import Word2VecSettings
from litloom.session import ship_package
from litloom.sources.staging import forget, staged

#: Words of a bag that a shard holds at most on average; larger inputs get more shards than the settings say.
SHARD_TOKENS = 2_000_000
#: Weights that driver and executors hold, of each of two kinds: words times the vectors' size.
MAX_CELLS = 20_000_000
#: Words that are drawn as noise for each pair, and the power of their counts that they are drawn by.
NOISE, NOISE_POWER = 5, 0.75
#: Tokens whose pairs are made at once, pairs of a step, and words of a row of summed weights.
CHUNK, STEP, BLOCK = 4096, 1024, 64
#: Weights are summed in units of its inverse.
UNIT = 1 << 20


@dataclass(frozen=True)
class SkipGramModel:
    """vectors: word, count, vector (array<double>), a staged or stored table."""

    vectors: DataFrame
    settings: Word2VecSettings

    def save(self, path: str, mode: str = "errorifexists") -> None:
        """A Parquet table whose rows carry the settings they were learnt with."""
        self.vectors.select("word", "count", "vector", F.lit(json.dumps(asdict(self.settings))).alias("settings")).write.mode(mode).parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SkipGramModel:
        table = spark.read.schema("word string, count long, vector array<double>, settings string").parquet(path)
        found = table.select("settings").head()
        return SkipGramModel(table.drop("settings"), Word2VecSettings(**json.loads(found.settings)) if found else Word2VecSettings())


def vocabulary(bags: DataFrame, min_count: int) -> DataFrame:
    """word, count of words in min_count places or more."""
    return bags.select(F.explode("terms").alias("word")).filter("word is not null").groupBy("word").agg(F.count("*").alias("count")).filter(F.col("count") >= min_count)


def add_rows(to: np.ndarray, at: np.ndarray, factor: np.ndarray, rows: np.ndarray) -> None:
    """Adds factor[i, j] * rows[i] to row at[i, j] of `to`, in place; what comes to one row is summed first, in the order of i and j."""
    flat = at.ravel()
    order = np.argsort(flat, kind="stable")
    met, edges = np.unique(flat[order], return_index=True)
    if len(met):
        added = rows[order // at.shape[1]]
        added *= factor.ravel()[order, None]
        to[met] += np.add.reduceat(added, edges, axis=0)


class Shard:
    """Weights that learn from a shard's bags, and how often each word was learnt."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray], noise: np.ndarray, settings: Word2VecSettings, round_: int, shard: int, tokens: int):
        self.weights = [w.astype("float64") for w in weights]
        self.learnt = [np.zeros(len(w), "int64") for w in weights]
        self.noise, self.settings, self.round, self.tokens = noise, settings, round_, max(tokens, 1)
        self.rng = np.random.Generator(np.random.PCG64([settings.seed, round_, shard]))
        self.step = min(STEP, max(32, 4 * len(noise)))
        self.held: list[np.ndarray] = []
        self.waiting = self.seen = 0

    def add(self, bag: np.ndarray) -> None:
        for a in range(0, len(bag), self.settings.max_sentence_length):
            part = bag[a : a + self.settings.max_sentence_length]
            self.held.append(part)
            self.waiting += len(part)
            if self.waiting >= CHUNK:
                self.learn()

    def learn(self) -> None:
        """Learns from the bags held: each word predicts those within a window of random width around it."""
        if not self.held:
            return
        words, bag = np.concatenate(self.held), np.repeat(np.arange(len(self.held)), [len(b) for b in self.held])
        wide = self.rng.integers(1, self.settings.window_size + 1, len(words))
        at, other = [], []
        for d in range(1, min(self.settings.window_size + 1, len(words))):
            near = np.flatnonzero(bag[d:] == bag[:-d])
            for centre, context in ((near, near + d), (near + d, near)):
                own = wide[centre] >= d
                at.append(centre[own])
                other.append(context[own])
        if at:
            at, other = np.concatenate(at), np.concatenate(other)
            order = self.rng.permutation(len(at))
            for a in range(0, len(order), self.step):
                some = order[a : a + self.step]
                done = (self.round + (self.seen + self.waiting * a / len(order)) / self.tokens) / self.settings.max_iter
                self._step(words[at[some]], words[other[some]], self.settings.step_size * max(1 - done, 1e-4))
        self.seen += self.waiting
        self.held, self.waiting = [], 0

    def _step(self, centre: np.ndarray, context: np.ndarray, rate: float) -> None:
        drawn = np.searchsorted(self.noise, self.rng.random((len(centre), NOISE)), side="right").clip(0, len(self.noise) - 1)
        outs = np.concatenate([context[:, None], drawn], 1)
        sign = np.zeros(outs.shape)
        sign[:, 0] = 1
        sign[:, 1:][drawn == context[:, None]] = np.nan  # noise that is the context itself teaches nothing
        a, b = self.weights[0][centre], self.weights[1][outs]
        error = np.nan_to_num(sign - 1 / (1 + np.exp(-np.einsum("nd,nkd->nk", a, b).clip(-30, 30)))) * rate
        add_rows(self.weights[0], centre[:, None], np.ones((len(centre), 1)), np.einsum("nk,nkd->nd", error, b))
        add_rows(self.weights[1], outs, error, a)
        np.add.at(self.learnt[0], centre, 1)
        np.add.at(self.learnt[1], outs, 1)


def _encoded(bags: DataFrame, ids: dict[str, int], n_shards: int) -> DataFrame:
    """shard, ids (int32 bytes) of each bag; words outside the vocabulary go, and so do bags of under two words."""
    known = bags.sparkSession.sparkContext.broadcast(ids)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array([known.value[t] for t in terms or () if t in known.value], "<i4") for terms in batch["terms"].to_pylist()]
            keep = [i for i, x in enumerate(found) if len(x) > 1]
            yield pa.RecordBatch.from_arrays([batch["shard"].take(pa.array(keep, pa.int64())), pa.array([found[i].tobytes() for i in keep], pa.binary())], ["shard", "ids"])

    dealt = bags.select(F.pmod(F.xxhash64("terms"), F.lit(n_shards)).cast("int").alias("shard"), "terms")
    return dealt.mapInArrow(encode, "shard int, ids binary")


def _round(bags: DataFrame, weights: tuple[np.ndarray, np.ndarray], noise: np.ndarray, tokens: dict[int, int], settings: Word2VecSettings, round_: int) -> tuple[np.ndarray, np.ndarray]:
    """The weights after a round, averaged over shards by how often each learnt a word; words that none met stay."""
    context = bags.sparkSession.sparkContext
    shared = context.broadcast((weights, noise, tokens))
    size = weights[0].shape[1]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, noise_, tokens_ = shared.value
        sums = [np.zeros(w.shape, "int64") for w in first]
        times = [np.zeros(len(w), "int64") for w in first]
        now, number = None, None

        def finish() -> None:
            now.learn()
            for k in (0, 1):
                sums[k] += np.rint(now.weights[k] * UNIT).astype("int64") * now.learnt[k][:, None]
                times[k] += now.learnt[k]

        for batch in batches:
            for shard, bag in zip(batch["shard"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if shard != number:
                    if now:
                        finish()
                    now, number = Shard(first, noise_, settings, round_, shard, tokens_[shard]), shard
                now.add(np.frombuffer(bag, "<i4"))
        if now:
            finish()
            for k in (0, 1):
                for a in range(0, len(times[k]), BLOCK):
                    if times[k][a : a + BLOCK].any():
                        cells = np.concatenate([times[k][a : a + BLOCK, None], sums[k][a : a + BLOCK]], 1)
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([a // BLOCK], pa.int32()), pa.array([cells.tobytes()], pa.binary())], ["kind", "block", "cells"])

    def total(table: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table["cells"])
        return pa.table({"kind": table["kind"][:1], "block": table["block"][:1], "cells": pa.array([cells.tobytes()], pa.binary())})

    schema = "kind int, block int, cells binary"
    ordered = bags.repartition("shard").sortWithinPartitions("shard", "ids")
    met = staged(ordered.mapInArrow(train, schema).groupBy("kind", "block").applyInArrow(total, schema), "weights")
    out = tuple(w.copy() for w in weights)
    for row in met.toLocalIterator():  # as many cells as the weights have, which are bounded
        cells = np.frombuffer(row.cells, "<i8").reshape(-1, 1 + size)
        some = np.flatnonzero(cells[:, 0])
        out[row.kind][row.block * BLOCK + some] = cells[some, 1:] / cells[some, :1] / UNIT
    forget(met)
    shared.destroy()
    return out


def fit_skipgram(bags: DataFrame, settings: Word2VecSettings = Word2VecSettings()) -> SkipGramModel:
    """Vectors of the words of bags (terms), by skip-gram with noise, in settings.max_iter rounds over every bag.

    There are settings.num_partitions shards, or more for a large input: as many as hold SHARD_TOKENS words each. The same
    bags give the same vectors, in whatever order or partitions they come. Words in fewer than min_count places have no
    vector. Driver and tasks hold the vocabulary and its weights; over MAX_CELLS is an error that asks for a larger
    min_count. Null words, null bags and bags of one word teach nothing; without words there are no vectors.
    """
    spark = bags.sparkSession
    ship_package(spark)
    words = staged(vocabulary(bags, settings.min_count), "vocabulary")
    size = words.count()
    if size * settings.vector_size > MAX_CELLS:
        forget(words)
        raise ValueError(f"{size} words of {settings.vector_size} numbers are more than {MAX_CELLS}; raise min_count or lower vector_size")
    listed = sorted(words.collect(), key=lambda r: (-r["count"], r.word))
    counts = np.array([r["count"] for r in listed], "float64")
    n_shards = max(settings.num_partitions, int(counts.sum()) // SHARD_TOKENS + 1)
    encoded = staged(_encoded(bags, {r.word: i for i, r in enumerate(listed)}, n_shards), "bags")
    tokens = {r.shard: r.n for r in encoded.groupBy("shard").agg((F.sum(F.octet_length("ids")) / 4).cast("long").alias("n")).collect()}
    noise = np.cumsum(counts**NOISE_POWER) / max((counts**NOISE_POWER).sum(), 1)
    start = np.random.Generator(np.random.PCG64(settings.seed)).random((size, settings.vector_size)) - 0.5
    weights = (start / settings.vector_size, np.zeros((size, settings.vector_size)))
    for round_ in range(settings.max_iter):
        weights = _round(encoded, weights, noise, tokens, settings, round_)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype="int32") * settings.vector_size), pa.array(weights[0].ravel()))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("count", T.LongType()), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    table = pa.table({"word": pa.array([r.word for r in listed], pa.string()), "count": pa.array([r["count"] for r in listed], pa.int64()), "vector": flat})
    out = staged(spark.createDataFrame(table, schema), "vectors")
    forget(words, encoded)
    return SkipGramModel(out, settings)
