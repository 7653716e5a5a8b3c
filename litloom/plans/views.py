"""Stand-ins for the inputs of the literature operators, over the star-schema tables: one SQL text for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_matches": """
SELECT l_orderkey AS pmid, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE concat('PMC', CAST(l_orderkey AS STRING)) END AS pmcid,
       CAST(l_shipdate AS DATE) AS date,
       CASE l_linenumber WHEN 1 THEN 'title' WHEN 2 THEN 'abstract' WHEN 3 THEN 'concl' WHEN 4 THEN 'results' WHEN 5 THEN 'discuss' WHEN 6 THEN 'methods' ELSE 'appendix' END AS section,
       CASE l_suppkey % 3 WHEN 0 THEN 'DS' WHEN 1 THEN 'GP' ELSE 'CD' END AS type,
       concat(CASE l_suppkey % 3 WHEN 0 THEN 'EFO_' WHEN 1 THEN 'ENSG' ELSE 'CHEMBL' END, CAST(l_partkey % 50 AS STRING)) AS keywordId,
       CASE WHEN l_linenumber = 7 THEN concat(p_type, ' ', p_name) WHEN l_linenumber % 2 = 1 THEN concat(p_name, ' ', CAST(p_partkey % 29 AS STRING)) ELSE upper(concat(p_brand, '-', CAST(p_partkey % 31 AS STRING))) END AS label,
       CAST(l_quantity AS INT) AS startInSentence, CAST(l_quantity AS INT) + length(p_name) AS endInSentence, l_returnflag <> 'N' AS isMapped
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_coocs": """
SELECT a.l_orderkey AS pmid, CASE WHEN a.l_orderkey % 3 = 0 THEN NULL ELSE concat('PMC', CAST(a.l_orderkey AS STRING)) END AS pmcid, 'GP' AS type1, 'DS' AS type2,
       concat(pa.p_name, ' ', CAST(pa.p_partkey % 29 AS STRING)) AS label1, concat(pb.p_name, ' ', CAST(pb.p_partkey % 29 AS STRING)) AS label2,
       concat('ENSG', CAST(a.l_partkey % 50 AS STRING)) AS keywordId1, concat('EFO_', CAST(b.l_partkey % 50 AS STRING)) AS keywordId2,
       round(a.l_discount * 100) AS evidence_score, d.text AS text, a.l_returnflag <> 'N' AS isMapped
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey JOIN part pa ON a.l_partkey = pa.p_partkey JOIN part pb ON b.l_partkey = pb.p_partkey JOIN documents d ON d.doc_id = a.l_partkey % (SELECT count(*) FROM documents)
WHERE a.l_suppkey % 3 = 1 AND b.l_suppkey % 3 = 0""",
    "v_vectors": """
SELECT concat(CASE vec_id % 3 WHEN 0 THEN 'EFO_' WHEN 1 THEN 'ENSG' ELSE 'CHEMBL' END, CAST(CAST((vec_id - vec_id % 3) / 3 AS BIGINT) AS STRING)) AS word, embedding AS vector
FROM embeddings""",
    "v_pubs": """
SELECT CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN '0' WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(doc_id AS STRING) END AS pmid,
       CASE WHEN doc_id % 2 = 0 THEN concat('PMC', CAST(doc_id AS STRING)) WHEN doc_id % 5 = 0 THEN '' ELSE NULL END AS pmcid,
       CASE WHEN doc_id % 17 = 0 THEN 'not-a-date' WHEN doc_id % 19 = 0 THEN '' ELSE concat('20', lpad(CAST(doc_id % 24 AS STRING), 2, '0'), '-0', CAST(doc_id % 9 + 1 AS STRING), '-15') END AS pubDate,
       CASE doc_id % 8 WHEN 0 THEN 'Title' WHEN 1 THEN 'ABSTRACT' WHEN 2 THEN 'concl' WHEN 3 THEN 'results' WHEN 4 THEN 'discuss' WHEN 5 THEN 'methods' WHEN 6 THEN 'appendix' ELSE NULL END AS section, text
FROM documents""",
    "v_epmcids": "SELECT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id AS STRING) END AS PMID, CASE WHEN doc_id % 9 = 1 THEN 'MID1' ELSE concat('PMC', CAST(doc_id AS STRING)) END AS PMCID FROM documents",
    "v_terms": "\nUNION ALL\n".join(
        f"""SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'EFO_' WHEN 1 THEN 'ENSG' ELSE 'CHEMBL' END, CAST(p_partkey % 50 AS STRING)) AS keywordId,
       CASE p_partkey % 3 WHEN 0 THEN 'DS' WHEN 1 THEN 'GP' ELSE 'CD' END AS type, {text} AS text, CAST({factor} AS DOUBLE) AS factor, '{key}' AS keyType FROM part"""
        for text, factor, key in (("concat(p_name, ' ', CAST(p_partkey % 29 AS STRING))", 1.0, "LT"), ("concat(p_brand, '-', CAST(p_partkey % 31 AS STRING))", 0.999, "TT"), ("concat(p_type, ' ', p_name)", 0.998, "LT"))
    ),
}
_TABLES = {"v_matches": "lineitem part", "v_coocs": "lineitem part documents", "v_vectors": "embeddings", "v_pubs": "documents", "v_epmcids": "documents", "v_terms": "part"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES[name].split()}
    for table, df in tables.items():
        df.createOrReplaceTempView(table)
    return spark.sql(VIEWS[name])


def with_views(*names: str) -> str:
    """The views as the beginning of a WITH clause."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
