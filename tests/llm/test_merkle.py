"""The Merkle manifest against a plain tree in Python."""

from hashlib import sha256
from zlib import crc32

import pytest

from litloom.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    """The root, and each leaf's siblings by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for r in range(0, len(nodes), 16):
            for j in range(r, min(r + 16, len(nodes))):
                for leaf in owners[j]:
                    paths[leaf].append((nodes[r:j], nodes[j + 1 : r + 16]))
        owners = [sum(owners[r : r + 16], []) for r in range(0, len(nodes), 16)]
        nodes = [_h(*nodes[r : r + 16]) for r in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain_digest(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for rows_of in by.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = [_tree([_leaf(r) for r in by[s]]) for s in names]
    root, tops = _tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for s, (subroot, paths), top in zip(names, trees, tops, strict=True):
        for row, path in zip(by[s], paths, strict=True):
            hit = row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            node = _leaf((*row[:4], lower(row[4])) if hit else row)
            for left, right in path + top:
                node = _h(*left, node, *right)
            out.append((row[0], _leaf(row), subroot, root, _h(*(x for left, right in path + top for x in left + right)), node, node == root))
    return out


def _same(spark, rows, height):
    got = [tuple(r) for r in merkle.merkle_digest(spark.createDataFrame(rows, COLUMNS).repartition(7), height).collect()]
    assert sorted(got, key=repr) == sorted(plain_digest(rows), key=repr)
    return got


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (None, None, None, None, ""), (3, "", "en", 1, "A"), (3, "", "en", 1, "A"), (3, "", "en", 1, "b"),
    (5, "é", "fr", 9, "É"), (6, "z", None, 2, "Zz"), (7, "\U0001f600", "de", 3, "q" * 3_000_000), (8, "a", "en", 0, None), (-4, "a", "en", 0, ""),
]


@pytest.mark.parametrize("height", [1, 3])
def test_equals_a_plain_tree(spark, height):
    rows = ODD + [(i % 700, f"s{i % 11 % 3}" if i % 5 else None, "en", i, f"Text {i} Of Ä" * (i % 4)) for i in range(1500)]
    rows += [(10_000 + i, f"w{i}", "en", i, "X") for i in range(40)]  # a tree of sources of two levels
    got = _same(spark, rows, height)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 273])
def test_runs_of_any_length(spark, n):
    _same(spark, [(i, "s", "en", i, f"T{i}") for i in range(n)], 1)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert merkle.merkle_digest(empty).collect() == []
    names = ["grp", "idx", "n", "node", "part", "at", "rows", "path", "block", "name", "root", "leaf", "changed"]
    rows = [(1, "s", "en", 2, "Ab", *names), (2, None, "en", 2, "Ab", *names)]
    df = spark.createDataFrame(rows, ["doc_id", "source", "lang", "n_chars", "text", *names])
    assert sorted(map(tuple, merkle.merkle_digest(df).collect())) == sorted(plain_digest([r[:5] for r in rows]))


def test_proofs_and_carried_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"s{i % 2}", "en", i, f"t{i}") for i in range(100)], COLUMNS)
    got = merkle.merkle_proofs(docs, {"twice": F.col("doc_id") * 2}, 1).withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(got) == 100 and all(r.again == r.root and r.twice == 2 * r.doc_id and r.position == r.doc_id // 2 and r.source == f"s{r.doc_id % 2}" for r in got)
