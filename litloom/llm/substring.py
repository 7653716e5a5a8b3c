"""Substring dedup: repeated windows of words, counted in the buckets of their minimisers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.windows import Kind, covered, repeated_spans

WINDOW = 35
#: Words in a minimiser. Shorter ones make longer runs, but common phrases crowd their buckets.
GRAM = 8


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for each distinct pair."""
    return np.unique(left * (right.max(initial=0) + 1) + right, return_inverse=True)[1]


def counter(window: int):
    """Counts a bucket's windows by sorting: words are numbered, then pairs of runs of 1, 2, 4, ... words."""
    def verdict(packed: list[bytes], windows: np.ndarray, n: np.ndarray) -> np.ndarray:
        number: dict[bytes, int] = {}
        words = np.array([number.setdefault(w, len(number)) for p in packed for w in p.split()], np.int64)
        more = window - 1
        starts = np.repeat(np.cumsum(windows + more) - (windows + more) - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        rank, have = words, 1
        while have * 2 <= window:
            rank = _pair(rank[: len(rank) - have], rank[have:])
            have *= 2
        if have < window:
            rank = _pair(rank[: len(words) - more], rank[window - have : window - have + len(words) - more])
        rank = np.unique(rank[starts], return_inverse=True)[1]
        return np.bincount(rank, weights=np.repeat(n, windows))[rank] > 1

    return verdict


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """rid, did, doc_id, n_words, n_removed, text: every row's words but those in a window that starts elsewhere too.

    Kept words are joined by one space; the text of a null text is null. Texts shorter than the window keep
    every word. Repeated rows are documents of their own, so they lose every word that a window covers. All
    copies go, the first one too; windows are judged on the input. Other columns of docs are ignored.
    """
    kind = Kind(True, window, gram)
    rows, spans = repeated_spans(docs, kind, counter(window), False)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for i in range(batch.num_rows):
                words = batch.column("text")[i].as_py().encode().split()
                found = batch.column("spans")[i].as_py()
                gone = covered(len(words), found, window) if found else np.zeros(0, bool)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words
                texts.append(None if batch.column("void")[i].as_py() else b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", "did", "doc_id")), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
                ["rid", "did", "doc_id", "n_words", "n_removed", "text"],
            )

    return rows.join(spans, ["rid", "did"], "left").select("rid", "did", "doc_id", "text", "void", "spans").mapInArrow(remove, "rid long, did long, doc_id long, n_words long, n_removed long, text string")


def substring_digest(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], window: int = WINDOW) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) by comparing all windows at once; for tests."""
    from collections import Counter

    all_words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for words in all_words:
        gone = set()
        for i in range(len(words) - window + 1):
            if count[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(words), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()))
    return out


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
r AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM w SEMI JOIN r USING (k)),
p AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
k AS (SELECT doc_id, count(*) AS n_left, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_left, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
