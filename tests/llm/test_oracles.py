"""Queries of the subpackage against their DuckDB SQL, on the given tables and on odd ones."""

import duckdb
import pytest

from litloom.llm.registry import ORACLE_SQL, QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _same(spark, name, folder):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'' if folder.startswith('/root') else '/*.parquet'}')")
    df = QUERIES[name](spark, folder)
    columns, found = sorted(df.columns), con.sql(ORACLE_SQL[name])
    at = [list(found.columns).index(c) for c in columns]
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    assert len(at) == len(found.columns) and got == sorted(tuple(str(r[i]) for i in at) for r in found.fetchall())
    return got


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_given_tables(spark, sf_dir, name):
    assert _same(spark, name, sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_tables(spark, tmp_path, name):
    long = " ".join(f"W{i % 700}" for i in range(3000))
    texts = [None, "", " ", "a", "Ab cD ef", "ab cd ef", long, long + " tail", long[:900], "é\U0001f600 " * 60, "é\U0001f600 " * 60, "x\ny\nx\n\n\nx", "a b c a b c", "#*$ %&|<>", "AbC" * 40, "AbC" * 41]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, i) for i, t in enumerate(texts)]
    rows += [(1000 + i, f"Row {i % 40}", None, f"w{i % 20}", None) for i in range(300)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [(0, None, 1), (1, [0.0, 0.0], 1), (2, [1.0, float("nan")], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.1], 1), (5, [1.0, 0.2], 1), (6, [1.0, 0.0], 2), (7, [1.0, 0.0], 2), (8, [1.0, 0.0], None), (9, [-1.0, 0.0], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert _same(spark, name, str(tmp_path))
