"""The steps processing, embedding, vectors and evidence, and all of them in that order."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from litloom import schemas
from litloom.config import Config
from litloom.operators import embedding, evidence, grounding, index, publications, skipgram, terms
from litloom.sources.publishing import Manifest, fingerprint, publish, state
from litloom.sources.staging import release, staged_tables
from litloom.sources.tables import CORRUPT, TableSpec, quarantined, read_records, read_table, with_source_file, write_table

log = logging.getLogger(__name__)


@dataclass
class Context:
    """A run: its session, its settings, and the tables that its steps have made so far."""

    spark: SparkSession
    config: Config
    made: dict[str, DataFrame] = field(default_factory=dict)
    #: Whether outputs that an earlier run has finished from the same inputs and settings are left as they are.
    resume: bool = False
    #: What outputs of the step now running are made from.
    of: str = ""

    def read(self, name: str, **more) -> DataFrame:
        """A table that an earlier step of this run made, or else what is stored under its name."""
        if name in self.made:
            return self.made[name]
        return read_table(self.spark, TableSpec(self.config.path(name), more.pop("format", self.config.output_format), **more))

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, f"{self.config.base}/output/{self.config.output_format}/_finished")

    def pending(self, *names: str) -> bool:
        """Whether one of these outputs is still to be made."""
        return not self.resume or not all(self.manifest.finished(n, self.config.path(n), self.of) for n in names)

    def put(self, name: str, write: Callable[[str], None]) -> None:
        """An output as write makes it at the path it is given: published whole, and entered as finished."""
        path = self.config.path(name)
        if self.resume and self.manifest.finished(name, path, self.of):
            log.info("%s is finished", name)
            return
        log.info("writing %s", name)
        publish(self.spark, path, write, self.config.mode)
        self.manifest.finish(name, path, self.of)

    def write(self, name: str, df: DataFrame, format: str | None = None) -> None:
        self.put(name, lambda path: write_table(df, TableSpec(path, format or self.config.output_format)))


def processing(ctx: Context) -> None:
    if not ctx.pending("qualityReport", "failedMatches", "failedCooccurrences", "matches", "cooccurrences", "literatureIndex"):
        return
    lookup = publications.id_lookup(ctx.read("epmcids", format="csv", options={"header": "true"}, schema=schemas.EPMC_IDS))
    diseases, targets, drugs = (ctx.read(n, format="parquet") for n in ("diseases", "targets", "drugs"))
    source = TableSpec(ctx.config.path("epmc"), "json", {"recursiveFileLookup": "true"}, schema=schemas.PUBLICATIONS)
    records, seen = read_records(ctx.spark, source), Observation()
    pubs = with_source_file(records.observe(seen, F.count(CORRUPT).alias("broken"))).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    entities = terms.entity_lookup(terms.all_terms(diseases, targets, drugs))
    before = staged_tables(ctx.spark)
    sentences, report = publications.observed_quality(publications.load_publications(pubs, lookup))
    found = grounding.ground(publications.usable(sentences), entities)
    ctx.write("qualityReport", report())
    if seen.get["broken"]:  # only then are the records read once more, for the lines themselves
        log.warning("%d broken records", seen.get["broken"])
        ctx.write("quarantine", quarantined(records))
    # Each of the two is read by more than one output; narrow rows, kept on disk.
    matches, coocs = (df.persist(StorageLevel.DISK_ONLY) for df in (found.matches, found.cooccurrences))
    try:
        ctx.write("failedMatches", found.matches_failed)
        ctx.write("failedCooccurrences", found.cooccurrences_failed)
        ctx.write("matches", matches)
        ctx.write("cooccurrences", coocs)
        ctx.write("literatureIndex", index.literature_index(matches, ranks=ctx.config.section_ranks))
    finally:
        matches.unpersist()
        coocs.unpersist()
        release(ctx.spark, before)


def embed(ctx: Context) -> None:
    if not ctx.pending("trainingSet", "W2VModel"):
        return
    bags = embedding.training_bags(ctx.read("matches"), ctx.config.section_ranks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ctx.write("trainingSet", bags)
        settings = ctx.config.word2vec
        fit = (lambda path: skipgram.fit_skipgram(bags, settings).save(path)) if settings.repeatable else (lambda path: embedding.fit_word2vec(bags, settings).save(path))
        ctx.put("W2VModel", fit)
    finally:
        bags.unpersist()


def _vectors(ctx: Context) -> DataFrame:
    path = ctx.config.path("W2VModel")
    if ctx.config.word2vec.repeatable:
        return skipgram.SkipGramModel.load(ctx.spark, path).vectors.select("word", "vector")
    return embedding.model_vectors(Word2VecModel.load(path))


def vectors(ctx: Context) -> None:
    if ctx.pending("vectors"):
        ctx.write("vectors", embedding.vector_table(_vectors(ctx)))


def pair_evidence(ctx: Context) -> None:
    if ctx.pending("evidence"):
        ctx.write("evidence", evidence.generate_evidence(ctx.read("matches"), ctx.read("cooccurrences"), _vectors(ctx), ctx.config.threshold, ctx.config.section_ranks))


#: What each step reads, in its inputs and in earlier steps' outputs.
READS = {"processing": ("epmcids", "diseases", "targets", "drugs", "epmc"), "embedding": ("matches",), "vectors": ("W2VModel",), "evidence": ("matches", "cooccurrences", "W2VModel")}
STEPS: dict[str, Callable[[Context], None]] = {"processing": processing, "embedding": embed, "vectors": vectors, "evidence": pair_evidence}


def resolve(names: Iterable[str]) -> list[str]:
    """The steps that names ask for, in their order; all stands for every one."""
    asked = list(names)
    if unknown := [n for n in asked if n != "all" and n not in STEPS]:
        raise ValueError(f"unknown steps: {', '.join(unknown)}; known: all, {', '.join(STEPS)}")
    return [n for n in STEPS if "all" in asked or n in asked]


def run_steps(ctx: Context, names: Iterable[str]) -> None:
    """Runs steps in their order. Each output appears whole, or not at all; of a run that was cut off, one with resume leaves
    what is finished and makes the rest, as long as inputs, earlier outputs and settings are the same. One run at a time
    writes to a base."""
    for name in resolve(names):
        log.info("step %s", name)
        settings = replace(ctx.config, paths={}, session={}, mode="")
        ctx.of = fingerprint(name, settings, *(f"{ctx.config.path(x)} {state(ctx.spark, ctx.config.path(x))}" for x in READS[name]))
        STEPS[name](ctx)
