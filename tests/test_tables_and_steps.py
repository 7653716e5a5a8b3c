import dataclasses
import gzip
import json

import pytest
from pyspark.sql.types import StructType

from litloom import config, schemas
from litloom.plans import steps
from litloom.plans.steps import Context, resolve, run_steps
from litloom.sources import publishing, tables
from litloom.streaming import publications as stream


def test_renames_reach_into_arrays(spark):
    df = spark.createDataFrame([(1, [(2, [(3,)])])], "`a b` int, `l_list x` array<struct<`in ner`: int, deep: array<struct<`x y`: int>>>>")
    out = tables.spaces_to_underscores(df)
    assert out.schema.simpleString() == "struct<a_b:int,l_list_x:array<struct<in_ner:int,deep:array<struct<x_y:int>>>>>" and out.collect()[0].l_list_x[0].deep[0].x_y == 3
    assert tables.snake_to_camel(out).columns == ["aB", "lListX"]


def test_read_and_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    for format in ("json", "parquet"):
        spec = tables.TableSpec(str(tmp_path / format), format, partition_by=("k",), schema=StructType.fromDDL("n int, k string"))
        tables.write_tables({"t": (df, spec)})
        assert sorted(map(tuple, tables.read_tables(spark, {"t": spec})["t"].collect())) == [(1, "a"), (2, "b")]
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
            tables.write_table(df, spec)
    assert list(tables.numbered([spec, spec])) == ["r0", "r1"] and tables.default_outputs("b", "json", "x")["x"].path == "b/x"
    assert tables.conform(df, StructType.fromDDL("k string, more double")).collect()[0].more is None


def test_config_layers_and_substitution(tmp_path):
    (tmp_path / "below.json").write_text('{"vars": {"release": "22.04", "root": "/data/${release}"}, "threshold": 0.5, "word2vec": {"seed": 1, "vector_size": 9}}')
    (tmp_path / "top.json").write_text('{"include": "below.json", "base": "${root}/runs", "word2vec": {"seed": 2}, "paths": {"epmc": "${base}/epmc-${release}"}, "session": {"spark.driver.maxResultSize": "0"}}')
    got = config.load(str(tmp_path / "top.json"), threshold=0.25)
    assert (got.base, got.threshold, got.word2vec.seed, got.word2vec.vector_size) == ("/data/22.04/runs", 0.25, 2, 9)
    assert got.path("epmc") == "/data/22.04/runs/epmc-22.04" and got.session == {"spark.driver.maxResultSize": "0"}
    (tmp_path / "loop.json").write_text('{"include": ["below.json", "loop.json"]}')
    for bad in ('{"base": "${nothing}"}', '{"base": "${base}"}', '{"vars": {"a": "${b}", "b": "${a}"}, "base": "${a}"}', (tmp_path / "loop.json").read_text()):
        (tmp_path / "loop.json").write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load(str(tmp_path / "loop.json"))


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"output-format": "parquet", "word2vec": {"max-iter": 1}, "section_ranks": [{"section": "title", "rank": 1, "weight": 1.0}]}))
    got = config.load(str(path), base="/b", paths={"epmc": "/elsewhere"})
    assert got.word2vec.max_iter == 1 and got.path("matches") == "/b/output/parquet/matches" and got.path("epmc") == "/elsewhere" and len(got.section_ranks) == 1
    for bad in ({"nope": 1}, {"threshold": "high"}, {"word2vec": {"x": 1}}):
        with pytest.raises(config.ConfigError):
            config.load(**bad)


def test_steps_are_known():
    assert resolve(["evidence", "processing"]) == ["processing", "evidence"] and len(resolve(["all"])) == 4
    with pytest.raises(ValueError, match="unknown steps: x"):
        resolve(["x"])


def inputs(spark, base):
    pubs = []
    for i in range(12):
        sentences = [
            {"section": "Title", "text": "t", "matches": [{"label": "lung cancers", "type": "DS", "startInSentence": 0, "endInSentence": 5, "sectionStart": 0, "sectionEnd": 5}, {"label": "TP-53", "type": "GP"}], "co-occurrence": [{"label1": "TP-53", "label2": "lung cancers", "type": "GP-DS", "sentEvidenceScore": 7.0}]},
            {"section": "abstract", "text": "u", "matches": [{"label": "unheard of", "type": "CD"}], "co-occurrence": []},
        ]
        pubs.append({"pmid": str(i + 1), "pmcid": None, "pubDate": "2020-02-03", "organisms": [], "sentences": sentences})
    (base / "inputs/epmc/deep").mkdir(parents=True)
    (base / "inputs/epmc/deep/p.json").write_text("\n".join([*map(json.dumps, pubs), '{"pmid": "77", "sentences": [{"section"', '{"pmid": "78", "sentences": 5}']))
    with gzip.open(base / "inputs/PMID_PMCID_DOI.csv.gz", "wt") as f:
        f.write("PMID,PMCID\n1,PMC1\n99,PMC99\n")
    for name, row, schema in (("diseases", ("EFO_1", "lung cancer", (None, None, None, None)), schemas.DISEASES), ("targets", ("ENSG1", "tumor protein", "TP53", [], [], [], [], []), schemas.TARGETS), ("molecule", ("CHEMBL1", "aspirin", [], []), schemas.DRUGS)):
        spark.createDataFrame([row], schema).write.parquet(str(base / "inputs" / name))


def test_all_steps_end_to_end(spark, tmp_path):
    base = tmp_path
    inputs(spark, base)
    settings = config.load(base=str(base), threshold=-2.0, word2vec={"num_partitions": 1, "vector_size": 8})
    run_steps(Context(spark, settings), ["all"])
    read = lambda name: spark.read.json(settings.path(name))
    assert read("matches").count() == 22 and read("failedMatches").count() == 11  # record 1 has a full-text twin
    assert read("literatureIndex").filter("keywordId = 'EFO_1'").count() == 11 and read("vectors").count() == 2
    broken = read("quarantine").collect()
    assert sorted(r.record[:13] for r in broken) == ['{"pmid": "77"', '{"pmid": "78"'] and all(r.trace_source.endswith("deep/p.json") for r in broken)
    report = {r.flag: (r.rows, r.failed) for r in read("qualityReport").collect()}
    assert report["failed_pmid"] == (22, 0) and report["failed_pmcid"] == (22, 22) and len(report) == 8
    (row,) = read("evidence").collect()
    assert (row.targetFromSourceId, row.diseaseFromSourceMappedId, row.sharedPublicationCount, row.cooccurredPublicationCount) == ("ENSG1", "EFO_1", 11, 11)
    assert row.harmonicCooccurrenceSentiment == pytest.approx(0.7 * sum(1 / k**2 for k in range(1, 12)))


def test_a_killed_step_resumes(spark, tmp_path, monkeypatch):
    inputs(spark, tmp_path)
    settings = config.load(base=str(tmp_path), output_format="parquet")
    out, made = tmp_path / "output/parquet", []
    real = steps.write_table

    def dies(df, spec):
        if "literatureIndex" in spec.path:
            spec = dataclasses.replace(spec, mode="append")
            real(df.limit(1), spec)
            raise KeyboardInterrupt
        made.append(spec.path.rpartition("/")[2].partition(".")[0])
        real(df, spec)

    monkeypatch.setattr(steps, "write_table", dies)
    with pytest.raises(KeyboardInterrupt):
        run_steps(Context(spark, settings), ["processing"])
    assert not (out / "literatureIndex").exists() and (out / "matches").exists() and list(out.glob("literatureIndex.__part-*"))
    monkeypatch.setattr(steps, "write_table", lambda df, spec: (made.append(spec.path.rpartition("/")[2].partition(".")[0]), real(df, spec)))
    with pytest.raises(FileExistsError):
        run_steps(Context(spark, settings), ["processing"])
    made.clear()
    run_steps(Context(spark, settings, resume=True), ["processing"])
    assert [n for n in made if n != "quarantine"] == ["literatureIndex"] and not list(out.glob("*.__*"))
    assert spark.read.parquet(str(out / "literatureIndex")).filter("keywordId = 'EFO_1'").count() == 11
    made.clear()
    run_steps(Context(spark, settings, resume=True), ["processing"])
    assert made == []
    with pytest.raises(FileExistsError):  # other settings make other outputs
        run_steps(Context(spark, dataclasses.replace(settings, threshold=0.5), resume=True), ["processing"])


def test_published_whole_or_not_at_all(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    publishing.publish(spark, path, df.write.parquet)
    with pytest.raises(FileExistsError):
        publishing.publish(spark, path, df.write.parquet)
    publishing.publish(spark, path, None, "ignore")
    publishing.publish(spark, path, spark.range(5).write.parquet, "overwrite")
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]
    (tmp_path / "t").rename(tmp_path / "t.__old-1")  # cut off between the two renames
    (tmp_path / "t.__part-2").mkdir()
    publishing.clean(spark, path)
    assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_only_partitions_with_rows_are_replaced(spark, tmp_path):
    spec = tables.TableSpec(str(tmp_path / "t"), partition_by=("k",), mode="overwrite_partitions")
    tables.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string"), spec)
    tables.write_table(spark.createDataFrame([(3, "b"), (4, "c")], "n int, k string"), spec)
    assert sorted(map(tuple, spark.read.parquet(spec.path).collect())) == [(1, "a"), (3, "b"), (4, "c")]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps({"pmid": "5", "pmcid": None, "pubDate": "2020", "organisms": [], "sentences": [{"section": "Title", "text": "x", "matches": [], "co-occurrence": []}]}))
    lookup = spark.createDataFrame([("1", "PMC1")], "pmid_lut string, pmcid_lut string")
    query = stream.write_stream(stream.usable_sentences(stream.read_stream(spark, str(tmp_path / "in")), lookup), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(60)
    assert [(r.pmid, r.section) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("5", "title")]
