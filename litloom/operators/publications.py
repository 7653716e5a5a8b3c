"""Publications: identifiers, dates, sentences, and a report of what is wrong with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def id_lookup(ids: DataFrame) -> DataFrame:
    """Distinct (pmid_lut, pmcid_lut) of rows with both ids, the second of the form PMC…; both as strings."""
    return ids.select(F.col("PMID").cast("string").alias("pmid_lut"), F.col("PMCID").alias("pmcid_lut")).filter(F.col("pmid_lut").isNotNull() & F.col("pmcid_lut").startswith("PMC")).distinct()


def known(c: Column) -> Column:
    """An identifier, or null for what stands for none."""
    return F.when((c != "") & (c != "0"), c)


def with_ids(pubs: DataFrame, lookup: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Publications with the pmid that their pmcid leads to, where they have none.

    A record with a pmid only goes if the lookup knows that pmid under a pmcid, as its full text is a record of
    its own. A pmcid with several pmids gives a row for each, unless unique_ids takes the smallest. Flags:
    failed_pmid, failed_pmcid, failed_pmcid_and_pmid as it came, failed_pmid_not_pmcid, and
    failed_recover_pmid_not_pmcid, which is true where the pmid was found.
    """
    pubs = pubs.withColumns({"pmid": known(F.col("pmid")), "pmcid": known(F.col("pmcid"))})
    pubs = pubs.withColumns({"failed_pmid": F.col("pmid").isNull(), "failed_pmcid": F.col("pmcid").isNull(), "failed_pmcid_and_pmid": F.col("pmid").isNull() & F.col("pmcid").isNull()})
    twin = lookup.select(F.col("pmid_lut").alias("pmid")).distinct()
    alone = pubs.join(twin, (pubs.pmid == twin.pmid) & pubs.pmcid.isNull(), "left_anti")
    by_pmcid = lookup.groupBy("pmcid_lut").agg(F.min("pmid_lut").alias("pmid_lut")) if unique_ids else lookup
    lost = F.col("pmid").isNull() & F.col("pmcid").isNotNull()
    joined = alone.withColumn("failed_pmid_not_pmcid", lost).join(by_pmcid, F.col("pmcid") == F.col("pmcid_lut"), "left")
    found = joined.withColumn("pmid", F.coalesce("pmid", "pmid_lut")).drop("pmid_lut", "pmcid_lut")
    return found.withColumn("failed_recover_pmid_not_pmcid", F.col("failed_pmid_not_pmcid") & F.col("pmid").isNotNull())


def with_dates(pubs: DataFrame) -> DataFrame:
    """date, year, month, day of pubDate, null where it is none, and failed_date."""
    pubs = pubs.withColumn("date", F.when(F.col("pubDate") != "", F.col("pubDate").try_cast("date")))
    return pubs.withColumns({"failed_date": F.col("date").isNull(), "year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")})


def non_ascii(text: Column) -> Column:
    """Whether a text has a character that isn't printable ASCII."""
    return text.rlike(r"[^\x20-\x7e]")


def with_sentences(pubs: DataFrame) -> DataFrame:
    """A row for each sentence, with its fields beside the publication's; section in lower case; flags."""
    rows = pubs.select(*(c for c in pubs.columns if c != "sentences"), F.inline("sentences"))
    return rows.withColumns({"section": F.lower("section"), "failed_section": F.col("section").isNull(), "failed_sentence": non_ascii(F.col("text"))})


def load_publications(pubs: DataFrame, lookup: DataFrame, unique_ids: bool = False) -> DataFrame:
    return with_sentences(with_dates(with_ids(pubs, lookup, unique_ids)))


def usable(sentences: DataFrame) -> DataFrame:
    """Sentences with a pmid and a section, without flags. Odd characters and dates are flagged, not dropped."""
    return sentences.drop(*(c for c in sentences.columns if c.startswith("failed_"))).filter(F.col("pmid").isNotNull() & F.col("section").isNotNull())


def _flags(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("failed_")]


def quality_report(rows: DataFrame) -> DataFrame:
    """How many rows each flag is true for: (flag, rows, failed)."""
    counts = rows.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c)).alias(c) for c in _flags(rows)))
    return counts.unpivot("rows", _flags(rows), "flag", "failed").select("flag", "rows", "failed")


def observed_quality(rows: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """rows, and what gives their quality_report once something has been made of them: the flags are counted as rows pass,
    in the job that first reads all of them, and not by a scan of their own."""
    seen, flags = Observation(), _flags(rows)
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c)).alias(c) for c in flags))

    def report() -> DataFrame:
        found = seen.get
        return rows.sparkSession.createDataFrame([(c, found["rows"], found[c]) for c in flags], "flag string, rows long, failed long")

    return watched, report
