"""Packing by powers of two: pieces of binary length, so that no sequence crosses documents or is padded."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import ship

MAX_TOKENS = 1024
#: Texts longer than this are encoded in parts of about this many characters.
PART = 100_000
#: A space between two characters that aren't white space. The tokenizer's pattern always starts a new piece
#: there, so what lies between such spaces can be encoded by itself.
CUT = re.compile(r"(?<=[!-~À-ɏ])(?= [!-~À-ɏ])")
#: A run of white space that the fast library's pattern may not get through; the tokenizer's own library does.
LONG_RUN = re.compile(r"\s{50000}")
#: Fixed value: the pattern by which byte-level tokenizers of this kind cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for a text without two white-space characters side by side, and without the part that looks ahead.
SINGLE, DOUBLE = PATTERN.replace(r"\s+(?!\S)|", ""), re.compile(r"\s\s")

_encoders: dict[str, Callable[[str], bytes]] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the
    others, in order, for the letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str) -> Callable[[str], bytes]:
    """Ordinary text to its ids as little-endian unsigned 32-bit integers, by the tokenizer file at path; what reads like one
    of its added tokens is ordinary text here.

    A byte-level BPE file whose ids are in the order of its merges is read as ranks, which a faster library
    merges by and gives the same ids; any other file is left to its own library. One for each worker and file.
    """
    if path in _encoders:
        return _encoders[path]
    import json

    import numpy as np

    def own() -> Callable[[str], list[int]]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    slow = None
    before = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] == "BPE" and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and not spec.get("normalizer"):
        import tiktoken

        byte_of = _byte_of()
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        single, double = (tiktoken.Encoding("file", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (SINGLE, PATTERN))
        whole = lambda text: (double if DOUBLE.search(text) else single)(text)
    else:
        whole = slow = own()

    def encode(text: str) -> bytes:
        nonlocal slow
        if len(text) <= PART:
            return np.array(whole(text), "<u4").tobytes()
        out, at = [], 0
        while at < len(text):
            found = CUT.search(text, at + PART)
            upto = found.start() if found else len(text)
            part = text[at:upto]
            if len(part) > 2 * PART and LONG_RUN.search(part):
                slow = slow or own()
                out.append(np.array(slow(part), "<u4").tobytes())
            else:
                out.append(np.array(whole(part), "<u4").tobytes())
            at = upto
        return b"".join(out)

    return _encoders.setdefault(path, encode)


@lru_cache(maxsize=8)
def text_encoder(path: str) -> Callable[[str], bytes]:
    """As encoder(), but for any text: the file's added tokens, such as an end of text, are their own ids wherever they stand.

    A text is cut at these first, the longest that starts at a place, and what lies between is encoded by itself. Added
    tokens that take in spaces, or ask for word bounds, leave the whole text to the tokenizer's own library.
    """
    import json

    import numpy as np

    with open(path, encoding="utf-8") as f:
        added = {t["content"]: t for t in json.load(f).get("added_tokens", ())}
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added.values()):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    plain = encoder(path)
    if not added:
        return plain
    mark = re.compile("(" + "|".join(re.escape(c) for c in sorted(added, key=lambda c: (-len(c), c))) + ")")
    ids = {c: np.array([t["id"]], "<u4").tobytes() for c, t in added.items()}

    def encode(text: str) -> bytes:
        parts = mark.split(text)
        return plain(text) if len(parts) == 1 else b"".join(ids[x] if i % 2 else plain(x) for i, x in enumerate(parts) if x)

    return encode


def lengths(n: int, most: int = MAX_TOKENS) -> list[int]:
    """n as pieces: as many of `most` as fit, then the powers of two of the rest, the largest first."""
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if n % most >> k & 1]


def packed_pieces(docs: DataFrame, tokenizer: str | None = None, most: int = MAX_TOKENS) -> DataFrame:
    """Every piece of every document: doc_id, start, length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    A document is its text's ids and then id 0; a null or empty text is the id 0 alone. most is a power of
    two. A piece is a sequence by itself: its length is a power of two, so it needs no padding. Sequences
    are numbered bucket by bucket of equal length: the bucket's number in the high bits, then the place in
    the scan. Repeated rows and null ids are documents of their own. Other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out: tuple[list, ...] = ([], [], [], [], [])
                held = 0
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = encode(text or "") + b"\0\0\0\0"
                    start, total = 0, len(ids) // 4
                    held += len(ids)
                    for n in lengths(total, most):
                        for column, value in zip(out, (doc_id, start, n, ids[4 * start : 4 * (start + n)], total), strict=True):
                            column.append(value)
                        start += n
                    if held > 16_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, TYPES, strict=True)], NAMES)
                        out, held = ([], [], [], [], []), 0
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, TYPES, strict=True)], NAMES)

    NAMES, TYPES = ["doc_id", "start", "length", "ids", "doc_tokens"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long")
    # monotonically_increasing_id() stays below 2^59 up to 2^26 partitions; 11 buckets fit above it.
    return pieces.withColumn("sequence_id", F.expr("shiftleft(cast(log2(length) as bigint), 59)") + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def sequences(docs: DataFrame, tokenizer: str | None = None, most: int = MAX_TOKENS) -> DataFrame:
    """The sequences themselves, ready to be written by bucket: length, sequence_id, ids, doc_id, start."""
    return packed_pieces(docs, tokenizer, most).select("length", "sequence_id", "ids", "doc_id", "start")


def write_sequences(docs: DataFrame, path: str, tokenizer: str | None = None, most: int = MAX_TOKENS) -> None:
    """The sequences written under path, a folder `length=N` for each bucket of equal lengths."""
    sequences(docs, tokenizer, most).write.partitionBy("length").parquet(path)


def pack_digest(docs: DataFrame) -> DataFrame:
    crc = F.crc32(F.col("ids")).alias("ids_crc32")
    return packed_pieces(docs).select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")
