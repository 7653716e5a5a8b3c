import datetime

from pyspark.sql import functions as F

from litloom import schemas
from litloom.operators import publications


def pubs(spark):
    one = [("Title", "plain", [("x", "DS", 1, 2, 3, 4)], [])]
    rows = [
        ("1", None, "2020-01-02", one), ("2", None, "2020-13-02", one), (None, "PMC3", "", one), ("", "PMC4", None, [("ABSTRACT", "naïve", [], [])]), ("0", "PMC5", "2020", [(None, "x", [], [])]),
        ("PPR1", None, "2021-05-06", one), ("7", "PMC7", "2021-05-06", None),
    ]
    return spark.createDataFrame([(a, b, c, [], d) for a, b, c, d in rows], schemas.PUBLICATIONS)


def lookup(spark):
    return publications.id_lookup(spark.createDataFrame([("1", "PMC1"), ("3", "PMC3"), ("33", "PMC3"), ("3", "PMC3"), (None, "PMC9"), ("8", "MID8"), ("9", None)], schemas.EPMC_IDS))


def test_lookup(spark):
    assert {tuple(r) for r in lookup(spark).collect()} == {("1", "PMC1"), ("3", "PMC3"), ("33", "PMC3")}


def test_ids(spark):
    got = sorted((r.pmid or "", r.pmcid or "", r.failed_recover_pmid_not_pmcid) for r in publications.with_ids(pubs(spark), lookup(spark)).collect())
    # 1 is known under PMC1 and goes; PMC3 has two pmids; PPR1 is no number and stays
    assert got == [("", "PMC4", False), ("", "PMC5", False), ("2", "", False), ("3", "PMC3", True), ("33", "PMC3", True), ("7", "PMC7", False), ("PPR1", "", False)]
    assert publications.with_ids(pubs(spark), lookup(spark), unique_ids=True).filter("pmcid = 'PMC3'").count() == 1


def test_dates(spark):
    got = {r.pmid: (r.date, r.year, r.failed_date) for r in publications.with_dates(pubs(spark)).collect() if r.pmid}
    assert got["1"] == (datetime.date(2020, 1, 2), 2020, False) and got["2"] == (None, None, True) and got["0"][0] == datetime.date(2020, 1, 1)


def test_sentences_and_report(spark):
    rows = publications.load_publications(pubs(spark), lookup(spark))
    kept = publications.usable(rows)
    assert {r.pmid for r in kept.collect()} == {"2", "3", "33", "PPR1"} and not [c for c in kept.columns if c.startswith("failed_")]
    report = {r.flag: (r.rows, r.failed) for r in publications.quality_report(rows).collect()}
    assert report["failed_sentence"] == (6, 1) and report["failed_section"] == (6, 1) and report["failed_recover_pmid_not_pmcid"] == (6, 2)
    assert rows.filter("section = 'title'").count() == 4 and rows.filter(F.size("matches") > 0).count() == 4
