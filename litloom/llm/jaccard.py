"""N-gram Jaccard join by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litloom.llm.components import components
from litloom.llm.runtime import as_scan, forget, keep_rows, ship, staged, with_row_key
from litloom.llm.windows import Spans, _batches, _mix, word_units

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
#: Elements in a partition of a band's largest sets, on average; and partitions in a group.
LOAD, GROUP = 1.1, 3
#: Shingles known as frequent, at most; they only order signatures, so the bound changes no result.
FREQUENT = 1 << 16
#: Sets of a crowd that a task holds, and sets that pass by them; a larger crowd has several such tasks.
BLOCK = 1024
#: Shingles whose signatures go to one bucket, about.
BUCKET = 1 << 21
#: Members that are compared with one copy of a hub's set.
HUB_MEMBERS = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of lower-cased words.

    A text of fewer words has one shingle, all of them; one without words has none.
    """
    units, firsts = word_units(_LOWER[data], offsets)
    spans = Spans(units, 1)
    at = np.arange(max(0, len(units) - width + 1))
    all_ = spans.of(at, at + width, at)
    for first, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if end - first >= width:
            yield np.unique(all_[first : end - width + 1])
        elif end > first:
            one = np.array([first])
            yield spans.of(one, np.array([end]), one)
        else:
            yield np.zeros(0, np.uint64)


def set_name(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    one = _mix(np.array([s.sum(dtype=np.uint64)]))
    two = _mix(np.array([_mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)]))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


def signatures(s: np.ndarray, frequent: np.ndarray, threshold: Fraction = THRESHOLD) -> np.ndarray:
    """The set's signatures: two sets at or above the threshold share at least one.

    Sizes fall into bands that double. A set signs for its own band, and for the next one if a similar set may
    lie there. For a band, the domain of hashes is cut into partitions and these into groups of GROUP. In each group
    the subsets of all partitions but one are enumerated; a signature is such a subset with all that the set has in
    it, if it has anything. Two similar sets differ in at most k elements, and an element that one of them lacks
    changes only the subsets with its partition, GROUP - 1 of its group; so at most `most` = (GROUP - 1) * k signatures
    of either set aren't the other's. Of any fixed order of signatures the first most + 1 are enough: the first one
    that both sets have lies in both prefixes. The order takes first those with most elements that aren't frequent, as
    unlike sets seldom share them. A set with no more than `most` signs with all of them and each of its elements, for
    another set that does so.
    """
    n = len(s)
    if not n:
        return np.zeros(0, np.uint64)
    partner = int(n / threshold)
    band = n.bit_length() - 1
    known = np.zeros(n, bool)
    if len(frequent):
        i = np.searchsorted(frequent, s)
        known = frequent[np.minimum(i, len(frequent) - 1)] == s
    out = []
    for b in (band, band + 1) if partner >= 2 << band else (band,):
        end = 2 << b  # sizes of the band are below
        most = (GROUP - 1) * int((1 - threshold) / (1 + threshold) * (n + min(partner, end - 1)))
        parts = 2 * end if end <= 64 else int(end / LOAD) + 1
        part = (((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        group, place = np.divmod(part[edge], GROUP)
        new = np.append(True, group[1:] != group[:-1])
        group, row = group[new], np.cumsum(new) - 1
        salt = np.uint64((b + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        content, fresh, there = np.zeros((len(group), GROUP), np.uint64), np.zeros((len(group), GROUP), np.int64), np.zeros((len(group), GROUP), np.int64)
        content[row, place] = np.add.reduceat(_mix(s ^ salt), edge)
        fresh[row, place] = np.add.reduceat(~known, edge, dtype=np.int64)
        there[row, place] = 1
        # all but one: what the group has without that one's
        some = there.sum(1)[:, None] > there
        subset = (group[:, None] * GROUP + np.arange(GROUP)).astype(np.uint64)
        token = _mix(content.sum(1)[:, None] - content + subset * np.uint64(0xD6E8FEB86659FD93))[some]
        if len(token) <= most:
            out += [token, _mix(s + salt)]
        elif len(token) == most + 1:
            out.append(token)
        else:
            rare = np.minimum((fresh.sum(1)[:, None] - fresh)[some], 255).astype(np.uint64)
            order = (np.uint64(255) - rare) << np.uint64(56) | token >> np.uint64(8)
            out.append(token[np.argpartition(order, most)[: most + 1]])
    return np.concatenate(out)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text with its set's size and name; and rows without a key for shingles seen twice in a batch."""
    for rows, data, offsets in _batches(batches):
        sets = list(shingle_sets(data, offsets))
        names = [set_name(s) for s in sets]
        key = [rows.column(c) for c in ("rid", "did", "doc_id")]
        yield pa.RecordBatch.from_arrays([*key, pa.array([len(s) for s in sets], pa.int64()), *(pa.array([x[i] for x in names], pa.int64()) for i in (0, 1))], _SETS.names)
        common, n = np.unique(np.concatenate(sets), return_counts=True)
        common, n = common[n > 2].view(np.int64), n[n > 2]
        none = pa.nulls(len(common), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array(n), pa.array(common), none], _SETS.names)


_SETS = pa.schema([(c, pa.int64()) for c in ("rid", "did", "doc_id", "n", "h1", "h2")])


def _sign(buckets: int, frequent: np.ndarray):
    """Signatures by bucket: for each batch of texts and bucket, the sets' names, how many of their signatures
    fall there, and these; of equal sets in a batch one signs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in _batches(batches):
            by_name = {set_name(s)[0]: s for s in shingle_sets(data, offsets) if len(s)}
            if not by_name:
                continue
            tokens = [signatures(s, frequent) for s in by_name.values()]
            owner = np.repeat(np.array(list(by_name), np.int64), [len(t) for t in tokens])
            token = np.concatenate(tokens)
            bucket = ((token >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, owner, token = bucket[order], owner[order], token[order]
            edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            blobs = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                mine = owner[a:b]
                e = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
                low = token[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                blobs.append((int(bucket[a]), mine[e].tobytes(), np.diff(np.append(e, b - a)).astype(np.uint32).tobytes(), low.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in blobs], pa.int32()), *(pa.array([x[i] for x in blobs], pa.binary()) for i in (1, 2, 3))], ["bucket", "owners", "counts", "tokens"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket, the distinct groups of two sets or more that share a signature, and how many they share."""
    def groups(owners: list[np.ndarray], tokens: list[np.ndarray]) -> pa.RecordBatch:
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.lexsort((owner, token))
        owner, token = owner[order], token[order]
        new = np.append(True, (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))
        owner, token = owner[new], token[new]
        edge = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(edge, len(token)))
        name = _mix(np.add.reduceat(_mix(owner.view(np.uint64)), edge) + size.astype(np.uint64))
        several = np.flatnonzero(size > 1)
        _, first, times = np.unique(name[several], return_index=True, return_counts=True)
        first = several[first]
        values = owner[np.repeat(edge[first] - np.cumsum(size[first]) + size[first], size[first]) + np.arange(size[first].sum())]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[first])), pa.int32()), pa.array(values))
        return pa.RecordBatch.from_arrays([pa.array(name[first].view(np.int64)), pa.array(times.astype(np.int64)), lists], ["name", "times", "members"])

    owners, tokens, now = [], [], None
    for batch in batches:
        for bucket, own, counts, low in zip(*(batch.column(c).to_pylist() for c in ("bucket", "owners", "counts", "tokens")), strict=True):
            if bucket != now and owners:
                yield groups(owners, tokens)
                owners, tokens = [], []
            now = bucket
            owners.append(np.repeat(np.frombuffer(own, np.int64), np.frombuffer(counts, np.uint32)))
            wide = np.zeros((len(low) // 5, 8), np.uint8)
            wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
            tokens.append(wide.view("<u8").ravel())
    if owners:
        yield groups(owners, tokens)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set beside the hubs that it is compared with, and beside itself where it is a hub."""
    for batch in batches:
        tasks = batch.column("tasks").to_pylist()
        for i, (_, data, offsets) in enumerate(_batches(iter([batch.slice(i, 1) for i in range(batch.num_rows)]))):
            blob = next(shingle_sets(data, offsets)).tobytes()
            mine = tasks[i]
            yield pa.RecordBatch.from_arrays([pa.array([t["hub"] for t in mine], pa.int64()), pa.array([t["part"] for t in mine], pa.int64()), pa.array([t["x"] for t in mine], pa.int64()), pa.array([blob] * len(mine), pa.binary())], ["hub", "part", "x", "blob"])


def _compare(threshold: Fraction):
    """Rows come sorted by hub and part, the hub's own first; similar pairs go out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for hub, part, x, blob in zip(*(batch.column(c).to_pylist() for c in ("hub", "part", "x", "blob")), strict=True):
                s = np.frombuffer(blob, np.uint64)
                if x == hub:
                    now, hub_set = (hub, part), s
                else:
                    assert now == (hub, part), "a hub's own set comes first"
                    i = np.searchsorted(hub_set, s)
                    shared = int((hub_set[np.minimum(i, len(hub_set) - 1)] == s).sum())
                    if shared * threshold.denominator >= threshold.numerator * (len(s) + len(hub_set) - shared):
                        a.append(min(hub, x))
                        b.append(max(hub, x))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of how many elements fall in each of 2 to 4 times as many bins as there are elements.

    Two sketches, the longer one folded, differ in no more bits than their sets do in elements.
    """
    bits = max(64, 4 << (len(s).bit_length() - 1))
    odd = np.bincount((s >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def fold(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each) with neighbouring bins joined until they are `words` long."""
    while sketches.shape[1] > words:
        pairs = np.unpackbits(sketches.view(np.uint8), axis=1).reshape(len(sketches), -1, 2)
        sketches = np.packbits(pairs[:, :, 0] ^ pairs[:, :, 1], axis=1).view(np.uint64)
    return sketches


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _batches(batches):
        sets = list(shingle_sets(data, offsets))
        yield pa.RecordBatch.from_arrays([rows.column("h1"), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s).tobytes() for s in sets], pa.binary())], ["v", "n", "sketch"])


def _cross(threshold: Fraction):
    """Rows come sorted by crowd, part and slice: first the sets that the part holds, then those of the slice. Out go
    pairs from different components that sizes and sketches don't rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        blocks: dict[int, tuple[np.ndarray, ...]] = {}

        def hold() -> dict[int, tuple[np.ndarray, ...]]:
            by_words: dict[int, list] = {}
            for v, root, n, sk in held:
                by_words.setdefault(len(sk) // 8, []).append((v, root, n, sk))
            return {w: (*(np.array([x[i] for x in xs], np.int64) for i in range(3)), np.frombuffer(b"".join(x[3] for x in xs), np.uint64).reshape(len(xs), w)) for w, xs in by_words.items()}

        for batch in batches:
            hub, other = [], []
            passing: dict[int, list] = {}

            def compare(passing=passing, hub=hub, other=other) -> None:
                for w, xs in passing.items():
                    v, root, n = (np.array([x[i] for x in xs], np.int64) for i in range(3))
                    sk = np.frombuffer(b"".join(x[3] for x in xs), np.uint64).reshape(len(xs), w)
                    for u, (v2, root2, n2, sk2) in blocks.items():
                        if not w // 2 <= u <= 2 * w:
                            continue
                        a, b = fold(sk, min(u, w)), fold(sk2, min(u, w))
                        step = max(1, (1 << 22) // b.size)
                        for i in range(0, len(a), step):
                            size, both = slice(i, i + step), n[i : i + step, None] + n2
                            far = np.bitwise_count(a[size, None] ^ b).sum(-1, dtype=np.int64)
                            near = (far * (threshold.numerator + threshold.denominator) <= both * (threshold.denominator - threshold.numerator)) & (root[size, None] != root2)
                            p, q = np.nonzero(near)
                            hub += np.minimum(v[i + p], v2[q]).tolist()
                            other += np.maximum(v[i + p], v2[q]).tolist()
                passing.clear()

            for crowd, part, slice_, guest, v, root, n, sk in zip(*(batch.column(c).to_pylist() for c in ("crowd", "part", "slice", "guest", "v", "root", "n", "sketch")), strict=True):
                if (crowd, part, slice_) != now:
                    compare()
                    now, held, blocks = (crowd, part, slice_), [], {}
                if not guest:
                    held.append((v, root, n, sk))
                    continue
                if held:
                    blocks, held = hold(), []
                passing.setdefault(len(sk) // 8, []).append((v, root, n, sk))
            compare()
            yield pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(other, pa.int64())], ["hub", "x"])

    return run


def _crossing(groups: DataFrame, root: DataFrame, sketches: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (hub, x) of different components that may be similar, among sets that share a signature.

    Groups that aren't of one component yet belong to the crowd of their commonest component. A crowd's sets that
    aren't of that component are held, about BLOCK to a part, and compared by their sketches with all of the crowd,
    about BLOCK of them to a slice; so every pair of different components in a group is compared, in a task of two
    blocks, and no pair is made before it has passed.
    """
    members = groups.select("name", F.explode("members").alias("v")).join(root, "v", "left").select("name", "v", F.coalesce("root", "v").alias("root"))
    shares = members.groupBy("name", "root").agg(F.count("*").alias("n"))
    main = shares.groupBy("name").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("n", "root")).alias("crowd")).filter("roots > 1").select("name", "crowd")
    of = staged(members.join(main, "name").select("crowd", "v", "root").distinct().join(sketches, "v"), "crowds")
    # Staged, so that the join has plain exchanges on both sides, whose large partitions Spark can split.
    blocks = staged(of.groupBy("crowd").agg(F.ceil(F.count_if(F.col("root") != F.col("crowd")) / BLOCK).alias("parts"), F.ceil(F.count("*") / BLOCK).alias("slices")), "blocks")
    sized = of.join(blocks, "crowd")
    dealt = lambda n: F.pmod(F.xxhash64("v"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    hosts = sized.filter("root != crowd").withColumn("part", dealt("parts")).withColumn("slice", every("slices")).withColumn("guest", F.lit(False))
    guests = sized.withColumn("slice", dealt("slices")).withColumn("part", every("parts")).withColumn("guest", F.lit(True))
    columns = ["crowd", "part", "slice", "guest", "v", "root", "n", "sketch"]
    rows = hosts.select(*columns).unionByName(guests.select(*columns)).repartition("crowd", "part", "slice").sortWithinPartitions("crowd", "part", "slice", "guest", "n")
    return rows.mapInArrow(_cross(threshold), "hub long, x long").distinct()


def _links(pairs: DataFrame, texts: DataFrame, threshold: Fraction) -> DataFrame:
    """Those of pairs (hub, x) whose sets are similar. A hub with many x is copied to as many tasks as they need."""
    counted = pairs.withColumn("part", F.floor((F.row_number().over(W.partitionBy("hub", F.pmod(F.xxhash64("x"), F.lit(64))).orderBy("x")) - 1) / (HUB_MEMBERS // 64)))
    own = counted.select("hub", "part", F.col("hub").alias("x")).distinct()
    tasks = counted.select("hub", "part", "x").union(own).groupBy("x").agg(F.collect_list(F.struct("hub", "part", "x")).alias("tasks"))
    sides = texts.join(tasks, texts.h1 == tasks.x).select("text", "tasks").mapInArrow(_unpack, "hub long, part long, x long, blob binary")
    ordered = sides.repartition("hub", "part").withColumn("other", F.col("hub") != F.col("x")).sortWithinPartitions("hub", "part", "other").drop("other")
    return ordered.mapInArrow(_compare(threshold), "a long, b long")


def similar_documents(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """rid, did, doc_id, n_shingles, component_id, root of every row.

    A row's set: its distinct shingles of five words, A-Z lower-cased; all its words, if they are fewer. Rows link
    at a Jaccard similarity of the threshold or more. component_id is the smallest doc_id that links reach; a
    row without words or text links with nothing. Null doc_ids take part but are never the smallest unless all
    are null; as doc_ids may be null or repeated, root tells components apart, and is null for a row that links
    with nothing for want of words. Repeated rows are rows of their own with equal sets. Sets are named by 128 bits, in candidates and
    links by 64 of them. Equal sets are one vertex throughout. Sets that share a signature are compared with
    one hub first; whatever is in different components after that is compared by sketches, and then in full
    where these don't rule a link out, so no link that joins components is lost.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = with_row_key(docs, "doc_id", "text").select("rid", "did", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = staged(rows.mapInArrow(_sets, "rid long, did long, doc_id long, n long, h1 long, h2 long"), "sets")
    sets = found.filter("rid is not null")
    classes = staged(sets.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("least"), F.first("rid").alias("rid"), F.first("did").alias("did")), "classes")
    top = found.filter("rid is null").groupBy("h1").agg(F.sum("n").alias("times")).orderBy(F.desc("times"), "h1").limit(FREQUENT).select("h1").collect()
    frequent = np.sort(np.array([r.h1 for r in top], np.int64).view(np.uint64))
    # A task holds a bucket of signatures at a time, so their number follows the input.
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")), (sets.agg(F.sum("n")).first()[0] or 0) // BUCKET)
    signed = rows.select("text").mapInArrow(_sign(buckets, frequent), "bucket int, owners binary, counts binary, tokens binary")
    groups = staged(signed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet, "name long, times long, members array<long>").groupBy("name").agg(F.sum("times").alias("times"), F.first("members").alias("members")), "groups")

    named = groups.select(F.explode("members").alias("h1")).distinct()
    wanted = classes.join(named, "h1").select("h1", "rid", "did")
    texts = staged(rows.join(wanted, ["rid", "did"]).select("h1", "text"), "texts")

    # First every set with one hub: of those that it shares a signature with, the one that shares most with any.
    # Copies of one text differ from it less than from each other, so it is their hub if it is there.
    member = groups.select("name", F.explode("members").alias("v"), (F.col("times") * F.size("members")).alias("weight"))
    share = member.groupBy("v").agg(F.sum("weight").alias("share"))
    best = member.join(share, "v").groupBy("name").agg(F.max("share").alias("share"), F.max_by("v", F.struct("share", "v")).alias("hub"))
    pairs = member.join(best, "name").groupBy(F.col("v").alias("x")).agg(F.max_by("hub", F.struct("share", "hub")).alias("hub")).filter("hub != x")
    pairs = staged(pairs, "pairs")
    links = staged(_links(pairs, texts, threshold), "links")
    forget(pairs)
    # Then what is left between components; pairs that a hub has tried are among them only if they failed.
    sketches = staged(texts.mapInArrow(_sketches, "v long, n long, sketch binary"), "sketches")
    crossing = staged(_crossing(groups, components(links), sketches, threshold), "crossing")
    forget(groups, sketches)
    root = components(links.union(_links(crossing, texts, threshold)))
    forget(links, crossing, texts)

    reached = staged(classes.join(root, classes.h1 == root.v, "left").select("h1", "h2", "n", "least", F.coalesce("root", "h1").alias("root")), "reached")
    forget(classes)
    # Staged, so that a large component's part of the join can be split.
    smallest = staged(reached.groupBy("root").agg(F.min("least").alias("component")), "smallest")
    named_classes = reached.join(smallest, "root").select("h1", "h2", "n", "component", "root")
    return sets.join(named_classes, ["h1", "h2", "n"], "left").select("rid", "did", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), "root")


def one_of_each(docs: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """docs with one row for each component: that of the smallest doc_id, and of the smallest row key if it has several."""
    docs = as_scan(docs)
    found = similar_documents(docs, threshold)
    single = found.filter("n_shingles = 0").select("rid", "did")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid", "did")).alias("first")
    kept = found.filter("n_shingles > 0").groupBy("root").agg(first).select("first.rid", "first.did").union(single)
    return keep_rows(docs, kept)


def jaccard_digest(docs: DataFrame) -> DataFrame:
    return similar_documents(docs).select("doc_id", "n_shingles", "component_id")


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id to (n_shingles, component_id) by comparing all pairs; for tests."""
    sets = {}
    for doc_id, text in rows:
        words = bytes(_LOWER[np.frombuffer((text or "").encode(), np.uint8)]).split()
        sets[doc_id] = {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)} or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(d: int) -> int:
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and find(a) != find(b) and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}
