"""Suffix-array dedup: later copies of long byte strings go, found through longest previous factors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.windows import Kind, covered, repeated_spans

LENGTH = 100
#: Bytes in a minimiser.
GRAM = 32


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _previous_smaller(x: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it that is smaller, or -1, by following entries' own answers."""
    out = np.arange(-1, len(x) - 1)
    open_ = np.arange(len(x))
    while True:
        open_ = open_[(out[open_] >= 0)]
        open_ = open_[x[out[open_]] > x[open_]]
        if not len(open_):
            return out
        out[open_] = out[out[open_]]


def factor_reaches(length: int):
    """Says of each window start whether its longest previous factor has at least `length` bytes.

    Suffixes are ranked by their first 8, 16, 32, ... bytes and then by `length`, ties by place. In that order
    the nearest suffixes with an earlier place, before (PSV) and after (NSV), have the longest common prefix
    with this one among all earlier places; the factor is the longer of the two.
    """
    def verdict(packed: list[bytes], windows: np.ndarray, n: np.ndarray) -> np.ndarray:
        text = np.frombuffer(b"".join(packed) + bytes(2 * length), np.uint8)
        size = len(text) - 2 * length
        lens = windows + (length - 1)
        starts = np.repeat(np.cumsum(lens) - lens - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        eight = np.zeros(size + length, np.uint64)
        for k in range(8):
            eight = eight << np.uint64(8) | text[k : k + size + length]
        rank, have = _ranks(eight), 8
        while have * 2 <= length:
            rank = _ranks(rank[: len(rank) - have] << 32 | rank[have:])
            have *= 2
        # two overlapping runs make up `length`; the windows' starts alone are ordered by them
        prefix = _ranks(rank[starts] << 32 | rank[starts + length - have])
        order = np.sort(prefix << 32 | np.arange(len(starts)))
        place, prefix_at = order & 0xFFFFFFFF, order >> 32
        reaches = np.zeros(len(starts), bool)
        before = _previous_smaller(place)
        after = len(place) - 1 - _previous_smaller(place[::-1])[::-1]
        for near, some in ((before, before >= 0), (after, after < len(place))):
            at = np.flatnonzero(some)
            reaches[place[at[prefix_at[near[at]] == prefix_at[at]]]] = True
        return reaches

    return verdict


def dedup_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: every row's UTF-8 bytes but those of strings seen earlier.

    A byte goes that a string of `length` bytes covers which also starts earlier: in a smaller doc_id, or in the
    same row at an earlier place. A null doc_id counts as 0 and rows with the same doc_id go by their row key.
    kept is binary, as a cut may fall within a character; empty for null and empty texts. Other columns of docs
    are ignored.
    """
    rows, spans = repeated_spans(docs, Kind(False, length, gram), factor_reaches(length), True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_bytes, n_removed, n_spans = [], [], [], []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py().encode()
                found = batch.column("spans")[i].as_py()
                gone = covered(len(text), found, length) if found else np.zeros(1, bool)
                n_bytes.append(len(text))
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if found else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.join(spans, ["rid", "did"], "left").select("rid", "did", "doc_id", "text", "void", "spans").mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def suffix_digest(docs: DataFrame) -> DataFrame:
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """doc_id to (n_bytes, n_removed, n_spans, kept_sha256), for tests; doc_ids are distinct."""
    seen: set[bytes] = set()
    out = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if (key := data[i : i + length]) in seen:
                gone[i : i + length] = True
            seen.add(key)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out[doc_id] = (len(data), int(gone.sum()), int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(data) else 0, hashlib.sha256(kept).hexdigest())
    return out
