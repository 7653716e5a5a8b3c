"""Windows of consecutive units (words or bytes) that occur more than once, found through their minimisers.

Every window is filed under the smallest hash among its m-unit grams; a run of windows with the same smallest
gram, at the same place, is a segment. Equal windows have equal smallest grams, so:

1. of equal texts one is judged; every window of the others is a repeat;
2. grams are counted, after each batch has counted its own, and segments with a gram that is seen once go;
3. segments with the same gram and the same content are one class, with a count and its earliest member;
4. classes that share their gram with another one send one copy of their text, packed, to the gram's bucket,
   where a verdict says which of the class's windows occur elsewhere (or earlier);
5. verdicts go back to the members, and from there to the documents.

Grams and contents are compared by 64 bits each, that is, segments by 128, and so are texts; windows in buckets are
compared by their text. A bucket takes HOT classes of a gram. The windows of a gram with more are filed anew, under
the longest gram that they have, which is the window itself, by 128 bits; so they are counted by sorting too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import forget, ship, staged, with_row_key

#: Units that are hashed at a time, and bytes of text that a batch of rows has at most unless one row has more.
CHUNK, BATCH_BYTES = 1 << 19, 1 << 21
#: Classes of one gram that a bucket takes in together; bytes of text that it sorts at a time.
HOT, BUCKET_BYTES = 20_000, 1 << 21
#: A class with more than one in so many of all members is a crowd; so there are fewer crowds than that.
SHARES = 512
#: Windows of a span that has all of its text's.
WHOLE = -1
_PLACE = 24  # bits for a place in a chunk

_rng = np.random.Generator(np.random.PCG64(20))
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) | 1 for x in _rng.integers(2**62, 2**63, 3)]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base modulo 2^64, and of its inverse."""
    held = _powers.get(which)
    if held is None or len(held[0]) < n:
        size = max(n, CHUNK + 4096)

        def upto(base: int) -> np.ndarray:
            out = np.full(size, np.uint64(base & (2**64 - 1)))
            out[0] = 1
            return np.multiply.accumulate(out)

        held = _powers[which] = (upto(_BASES[which]), upto(pow(_BASES[which], -1, 2**64)))
    return held


class Spans:
    """Polynomial hashes of spans of one array of 64-bit units."""

    def __init__(self, units: np.ndarray, which: int):
        n = len(units)
        power, self.inverse = _power(which, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice, inverse: np.ndarray | slice) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[inverse])


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts that lie in data between offsets, and each text's first word's number."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]  # a text's first word starts with it, whatever the text before ended with
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        base = starts[at]
        spans = Spans(_BYTES[data[base : ends[upto - 1]]], 0)
        s, e = starts[at:upto] - base, ends[at:upto] - base
        out[at:upto] = spans.of(s, e, s)
        at = upto
    return out, np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Kind:
    """What a unit is, the windows' length, and the grams' length, in units."""

    words: bool
    window: int
    gram: int

    @property
    def least_bytes(self) -> int:
        """A text of fewer bytes has no window."""
        return 2 * self.window - 1 if self.words else self.window

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return word_units(data, offsets) if self.words else (_BYTES[data], offsets)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` consecutive entries."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def segments(units: np.ndarray, offsets: np.ndarray, kind: Kind, contents: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (row, start in the row, windows, gram, content) for the texts whose units lie between offsets."""
    length, gram, n = kind.window, kind.gram, len(units)
    lens = np.diff(offsets)
    if not (lens >= length).any():
        return
    for base in range(0, n - length + 1, CHUNK):
        part = units[base : base + CHUNK + length - 1]
        count = len(part) - length + 1
        lo = int(np.searchsorted(offsets, base, "right")) - 1
        hi = int(np.searchsorted(offsets, base + len(part), "left"))
        edges = np.clip(offsets[lo : hi + 1] - base, 0, len(part))
        row = np.repeat(np.arange(lo, hi, dtype=np.int32), np.diff(edges))
        valid = row[:count] == row[length - 1 :]
        if not valid.any():
            continue
        spans = Spans(part, 1)
        starts = slice(0, len(part) - gram + 1)
        grams = spans.of(starts, slice(gram, None), starts)
        keyed = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
        place = _smallest(keyed, length - gram + 1) & np.uint64((1 << _PLACE) - 1)
        new = np.empty(count, bool)
        new[0] = True
        np.not_equal(place[1:], place[:-1], out=new[1:])
        new[1:] |= valid[1:] != valid[:-1]
        at = np.flatnonzero(new)
        run = np.diff(np.append(at, count))
        good = valid[at]
        at, run = at[good], run[good]
        rows = row[at]
        content = Spans(part, 2).of(at, at + run + length - 1, at) if contents else at
        yield rows, base + at - offsets[rows], run, grams[place[at].astype(np.int64)].view(np.int64), content.view(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows with about BATCH_BYTES of text, their text and the places where each text starts."""
    for batch in batches:
        texts = batch.column("text")
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        buffer = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES, "right")) - 1)
            yield batch.slice(at, upto - at), data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
            at = upto


def _count_grams(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in _batches(batches):
            units, firsts = kind.units(data, offsets)
            for _, _, _, grams, _ in segments(units, firsts, kind, False):
                gram, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.minimum(n, 2).astype(np.int32))], ["gram", "n"])

    return run


def _find_segments(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _batches(batches):
            did, rid = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("did", "rid"))
            units, firsts = kind.units(data, offsets)
            for row, start, n, gram, content in segments(units, firsts, kind, True):
                columns = (gram, content, did[row], rid[row], start.astype(np.int32), n.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "content", "did", "rid", "start", "windows"])

    return run


def _cut_segments(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                text = row["text"].encode()
                units = text.split() if kind.words else text
                more = kind.window - 1
                cuts = row["cuts"]
                taken = [units[c["start"] : c["start"] + c["windows"] + more] for c in cuts]
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": [c["gram"] for c in cuts], "content": [c["content"] for c in cuts], "n": [c["n"] for c in cuts], "did": [row["did"]] * len(cuts), "rid": [row["rid"]] * len(cuts),
                        "start": [c["start"] for c in cuts], "windows": [c["windows"] for c in cuts], "packed": [b" ".join(t) if kind.words else t for t in taken],
                    },
                    schema=_CUT,
                )

    return run


_CUT = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("did", pa.int64()), ("rid", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("packed", pa.binary())])


def _judge(verdict: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]):
    """Buckets: rows come sorted by gram, then by earliest member; whole grams are judged together.

    verdict takes the packed texts, their numbers of windows and their classes' counts, and says of each window
    whether it is a repeat.
    """
    def judged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        n = table.column("windows").to_numpy()
        flags = verdict(table.column("packed").to_pylist(), n, table.column("n").to_numpy())
        ends = np.cumsum(n)
        masks = [np.packbits(flags[e - k : e]).tobytes() if flags[e - k : e].any() else None for k, e in zip(n, ends, strict=True)]
        keep = np.array([m is not None for m in masks], bool)
        return pa.RecordBatch.from_arrays([pa.array(table.column(c).to_numpy()[keep]) for c in ("gram", "content")] + [pa.array([m for m in masks if m is not None], pa.binary())], ["gram", "content", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            grams = batch.column("gram").to_numpy()
            edges = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            sizes = np.cumsum([len(x) for x in batch.column("packed").to_pylist()])
            at = 0
            if held and held[-1].column("gram")[-1].as_py() != grams[0]:
                edges = np.append(0, edges)
            for edge in edges:  # up to here grams are whole
                if size + (sizes[edge - 1] - (sizes[at - 1] if at else 0) if edge > at else 0) >= BUCKET_BYTES:
                    if edge > at:
                        held.append(batch.slice(at, edge - at))
                    yield judged(held)
                    held, size, at = [], 0, edge
            if at < batch.num_rows:
                held.append(batch.slice(at))
                size += sizes[-1] - (sizes[at - 1] if at else 0)
        if held:
            yield judged(held)

    return run


def _deal_windows(kind: Kind):
    """Every window of a segment as a row: its own two hashes and where its class first has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = np.frombuffer(row["packed"], np.uint8)
                units, _ = kind.units(data, np.array([0, len(data)]))
                a = np.arange(row["windows"])
                two = [Spans(units, which).of(a, a + kind.window, a).view(np.int64) for which in (1, 2)]
                same = [np.full(len(a), row[c]) for c in ("gram", "content", "n", "did", "rid")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*two, *same, (row["start"] + a).astype(np.int32), a.astype(np.int32))], ["w1", "w2", "gram", "content", "n", "did", "rid", "start", "i"])

    return run


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = []
        for at, n in zip(batch.column("at").to_pylist(), batch.column("windows").to_pylist(), strict=True):
            flags = np.zeros(n, bool)
            flags[at] = True
            masks.append(np.packbits(flags).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("content"), pa.array(masks, pa.binary())], ["gram", "content", "mask"])


def _copies(rows: DataFrame, kind: Kind, spare_first: bool) -> tuple[DataFrame, DataFrame]:
    """(copies, whole): keys of the rows whose text an earlier row has, by (doc_id, row key); and of those of which
    every window is a repeat: the copies, and the first ones too unless they are spared."""
    key = rows.filter(F.octet_length("text") >= kind.least_bytes).select("rid", "did", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    keys = staged(key, "text-keys")
    groups = staged(keys.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("did", "rid")).alias("first")).filter("n > 1").drop("n"), "text-groups")
    among = staged(keys.join(groups, ["h1", "h2"]).select("rid", "did", (F.struct("did", "rid") == F.col("first")).alias("is_first")), "text-copies")
    forget(keys, groups)
    copies = among.filter("not is_first").select("rid", "did")
    return copies, copies if spare_first else among.select("rid", "did")


def repeated_spans(docs: DataFrame, kind: Kind, verdict, spare_first: bool, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the documents by row key, and for each row with repeats its segments that have any.

    spare_first: the first of equal windows, by (doc_id with null as 0, row key, start), is no repeat; else
    all of them are. A span is (start, windows, mask of repeated windows; null: all); one of WHOLE windows has all
    that the text has.
    """
    ship(docs.sparkSession)
    rows = with_row_key(docs, "doc_id", "text").select("rid", "did", "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("void"))
    plain = rows.select("did", "rid", "text")
    copies, whole = _copies(rows, kind, spare_first)
    counted = plain.select("text").mapInArrow(_count_grams(kind), "gram long, n int").groupBy("gram").agg(F.sum("n").alias("n"))
    # Staged, as is what else has a row for each key, so that the join has plain exchanges on both sides, whose large
    # partitions Spark can split.
    grams = staged(counted.filter("n > 1").select("gram"), "grams")
    found = plain.mapInArrow(_find_segments(kind), "gram long, content long, did long, rid long, start int, windows int")
    members = staged(found.join(grams, "gram", "left_semi").join(copies, ["rid", "did"], "left_anti"), "segments")
    forget(grams)
    classes = staged(members.groupBy("gram", "content").agg(F.count("*").alias("n"), F.min(F.struct("did", "rid", "start")).alias("first"), F.max("windows").alias("windows")), "classes")
    shared = staged(classes.groupBy("gram").agg(F.count("*").alias("classes")).filter("classes > 1"), "shared")
    asked = classes.join(shared, "gram").select("gram", "content", "n", "windows", "classes", "first.*")
    cuts = asked.groupBy("rid", "did").agg(F.collect_list(F.struct("gram", "content", "n", "start", "windows")).alias("cuts"))
    # The same columns as the last join takes, so that texts are dealt out once for both.
    packed = rows.join(cuts, ["rid", "did"]).select("rid", "did", "doc_id", "text", "void", "cuts").mapInArrow(_cut_segments(kind), "gram long, content long, n long, did long, rid long, start int, windows int, packed binary")
    crowded = shared.filter(F.col("classes") > hot).select("gram")
    if crowded.isEmpty():
        calm, deal = packed, None
    else:
        packed = staged(packed, "packed")
        calm, deal = packed.join(crowded, "gram", "left_anti"), packed.join(crowded, "gram", "left_semi")
    masks = calm.repartition("gram").sortWithinPartitions("gram", "did", "rid", "start").mapInArrow(_judge(verdict), "gram long, content long, mask binary")
    if deal is not None:
        single = staged(deal.mapInArrow(_deal_windows(kind), "w1 long, w2 long, gram long, content long, n long, did long, rid long, start int, i int"), "windows")
        earliest = single.groupBy("w1", "w2").agg(F.sum("n").alias("total"), F.min(F.struct("did", "rid", "start")).alias("earliest"))
        back = single.join(earliest, ["w1", "w2"]).filter(F.struct("did", "rid", "start") != F.col("earliest") if spare_first else F.col("total") > 1)
        sized = back.groupBy("gram", "content").agg(F.collect_list("i").alias("at")).join(classes.select("gram", "content", "windows"), ["gram", "content"])
        masks = masks.unionByName(sized.mapInArrow(_mask, "gram long, content long, mask binary"))
    settled = staged(classes.join(masks, ["gram", "content"], "left").filter("n > 1 or mask is not null").select("gram", "content", "n", "first", "mask"), "settled")
    # Members of a crowded class are all repeats but its first one, which alone goes on to the verdicts. There are
    # fewer than SHARES such classes, so they are known in every task, and none gets a crowd.
    least = max(1, (classes.agg(F.sum("n")).first()[0] or 0) // SHARES)
    name, place = F.xxhash64("gram", "content"), F.xxhash64("did", "rid", "start")
    crowds = classes.filter(F.col("n") > least).select("gram", name.alias("name"), F.xxhash64("first.did", "first.rid", "first.start").alias("place")).collect()
    is_crowd = F.col("gram").isin([c.gram for c in crowds]) & name.isin([c.name for c in crowds]) & ~place.isin([c.place for c in crowds])
    crowd = members.filter(is_crowd).withColumn("mask", F.lit(None).cast("binary"))
    hit = members.filter(~is_crowd).join(settled, ["gram", "content"])
    if spare_first:
        first = F.struct("did", "rid", "start") == F.col("first")
        hit = hit.withColumn("mask", F.when(first, F.coalesce("mask", F.lit(b"")))).filter(F.col("mask").isNull() | (F.octet_length("mask") > 0))
    else:
        hit = hit.withColumn("mask", F.when(F.col("n") == 1, F.col("mask")))
    part = ["rid", "did", "start", "windows", "mask"]
    every = whole.select("rid", "did", F.lit(0).alias("start"), F.lit(WHOLE).alias("windows"), F.lit(None).cast("binary").alias("mask"))
    spans = hit.select(*part).unionByName(crowd.select(*part)).unionByName(every).groupBy("rid", "did").agg(F.collect_list(F.struct("start", "windows", "mask")).alias("spans"))
    return rows, spans


def covered(n: int, spans: list[dict] | None, window: int) -> np.ndarray:
    """Which of n units lie in a repeated window."""
    steps = np.zeros(n + 1, np.int64)
    for s in spans or ():
        count = n - window + 1 if s["windows"] == WHOLE else s["windows"]
        at = np.arange(count) if s["mask"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(s["mask"], np.uint8), count=s["windows"]))
        np.add.at(steps, s["start"] + at, 1)
        np.add.at(steps, s["start"] + at + window, -1)
    return np.cumsum(steps[:-1]) > 0
