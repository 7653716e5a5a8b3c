"""Embedding near-dedup: hierarchical navigable small-world graphs for shards of each label."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.components import components
from litloom.llm.runtime import ship, staged, with_row_key

COSINE = 0.98
#: Distinct vectors that a shard holds, about; a label with more has several shards.
SHARD = 32_768
#: Neighbours that a node links to when it comes in, and the most it has at the lowest level.
LINKS, MOST = 16, 48
#: Width of the beam when a node comes in, and of the first one that queries use.
BUILD_BEAM, BEAM = 64, 32
#: Queries with links, of few and of many, that an audit wants of a shard, and the share of its links that such a
#: query must find on the mean of either kind. Beams double to WIDEST; where that doesn't do, or where there are
#: fewer such queries, all vectors are compared, BLOCK at a time.
AUDIT, RECALL, FEW, WIDEST, BLOCK = 128, 0.99, 16, 512, 128
#: Nodes that come into a graph, and queries that are answered, at a time.
TOGETHER = 256


class Graph:
    """An HNSW graph over unit vectors, by inner product; nodes come in by batches, and queries are answered so.

    The nodes of a batch find their neighbours in the graph before it and among the batch's nodes before them. A step
    of many beams is a few calls of numpy, so that work follows the nodes that are met and not the steps.
    """

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.x = vectors
        n = len(vectors)
        rng = np.random.Generator(np.random.PCG64(seed))
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int), 8)
        self.near = [np.full((n, MOST if level == 0 else 2 * LINKS), -1, np.int32) for level in range(int(self.level.max(initial=0)) + 1)]
        self.size = [np.zeros(n, np.int64) for _ in self.near]
        self.entry = 0
        at = 1
        while at < n:
            upto = min(n, at + min(TOGETHER, at))
            self._insert(np.arange(at, upto))
            at = upto

    def _cos(self, nodes: np.ndarray, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.x[nodes], q[rows])

    def _unseen(self, rows: np.ndarray, nodes: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The level's links of the nodes that the rows haven't seen, once each, as pairs in order; now they have."""
        key = np.repeat(rows * seen.shape[1], nodes.shape[1])
        link = nodes.ravel()
        key = key[link >= 0] + link[link >= 0]
        key = np.sort(key[~seen.ravel()[key]])
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        seen.ravel()[key] = True
        return np.divmod(key, seen.shape[1])

    def beams(self, q: np.ndarray, entries: np.ndarray, width: int, level: int, least: float = np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """For each query the nodes nearest to it that a beam of this width meets, best first and -1 after the last, and
        their cosines; what was seen; and the pairs (query, node) met whose cosine is `least` or more.

        entries: an entry for each query.
        """
        near, b = self.near[level], len(q)
        seen = np.zeros((b, len(self.x)), bool)
        every = np.arange(b)
        seen[every, entries] = True
        ids, cos = np.full((b, width), -1), np.full((b, width), -np.inf)
        ids[:, 0], cos[:, 0] = entries, self._cos(entries, q, every)
        met = [(every[cos[:, 0] >= least], entries[cos[:, 0] >= least])]
        todo = ids >= 0  # nodes of the beams whose links haven't been followed
        while True:
            rows, places = np.nonzero(todo & (np.cumsum(todo, 1) <= 8))
            if not len(rows):
                return ids, cos, seen, met
            todo[rows, places] = False
            rows, new = self._unseen(rows, near[ids[rows, places]], seen)
            value = self._cos(new, q, rows)
            hits = value >= least
            met.append((rows[hits], new[hits]))
            better = value > cos[rows, -1]
            rows, new, value = rows[better], new[better], value[better]
            if not len(rows):
                continue
            some, starts, many = np.unique(rows, return_index=True, return_counts=True)
            shape = (len(some), width + int(many.max()))
            place = np.repeat(np.arange(len(some)), many), width + np.arange(len(rows)) - np.repeat(starts, many)
            ids2, cos2, todo2 = np.full(shape, -1), np.full(shape, -np.inf), np.zeros(shape, bool)
            ids2[:, :width], cos2[:, :width], todo2[:, :width] = ids[some], cos[some], todo[some]
            ids2[place], cos2[place], todo2[place] = new, value, True
            order = np.argsort(-cos2, 1, kind="stable")[:, :width]
            ids[some], cos[some], todo[some] = (np.take_along_axis(a, order, 1) for a in (ids2, cos2, todo2))

    def _choose(self, ids: np.ndarray, cos: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, best first and -1 after the last, those that are nearer to the row's node than to
        any chosen one, up to `most`; then, up to half of that, the best others; and -1 after the last."""
        out = np.full((len(ids), most), -1)
        step = max(1, (1 << 21) // max(1, ids.shape[1] ** 2))
        for a in range(0, len(ids), step):
            some, near = ids[a : a + step], cos[a : a + step]
            x = self.x[some]
            among = np.matmul(x, x.transpose(0, 2, 1))
            closest = np.full(some.shape, -np.inf)  # to any chosen one
            taken = np.zeros(some.shape, bool)
            many = np.zeros(len(some), int)
            for i in range(some.shape[1]):
                fits = (some[:, i] >= 0) & (many < most) & (closest[:, i] < near[:, i])
                taken[:, i] = fits
                many += fits
                closest[fits] = np.maximum(closest[fits], among[fits, i])
            order = np.argsort(~taken * 1 + (some < 0), 1, kind="stable")[:, :most]
            kept = np.take_along_axis(some, order, 1)
            kept[np.arange(kept.shape[1]) >= np.maximum(many, most // 2)[:, None]] = -1
            out[a : a + step, : kept.shape[1]] = kept
        return out

    def _ranked(self, ids: np.ndarray, cos: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(-cos, 1, kind="stable")[:, :most]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)

    def _insert(self, new: np.ndarray) -> None:
        q, level, top = self.x[new], self.level[new], int(self.level[self.entry])
        at = np.full(len(new), self.entry)
        for l in range(max(top, int(level.max())), -1, -1):  # noqa: E741
            passing = np.flatnonzero(level < l)
            if l <= top and len(passing):
                at[passing] = self.beams(q[passing], at[passing], 1, l)[0][:, 0]
            here = np.flatnonzero(level >= l)
            if not len(here):
                continue
            peers = q[here] @ q[here].T
            peers[np.triu_indices(len(here))] = -np.inf
            ids, cos = np.where(peers > -np.inf, new[here], -1), peers
            if l <= top:
                ids2, cos2, _, _ = self.beams(q[here], at[here], BUILD_BEAM, l)
                at[here] = ids2[:, 0]
                ids, cos = np.hstack((ids2, ids)), np.hstack((cos2, cos))
            ids, cos = self._ranked(ids, cos, BUILD_BEAM)
            self._link(new[here], self._choose(ids, cos, LINKS), l)
        if level.max() > top:
            self.entry = int(new[level.argmax()])

    def _link(self, nodes: np.ndarray, chosen: np.ndarray, level: int) -> None:
        """Links the nodes to those chosen for them, and these back to the nodes; where these come to have too many, to
        the ones chosen anew."""
        near, size = self.near[level], self.size[level]
        most = near.shape[1]
        near[nodes, : chosen.shape[1]] = chosen
        size[nodes] = (chosen >= 0).sum(1)
        back, at = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
        order = np.argsort(back, kind="stable")
        order = order[back[order] >= 0]
        back, at = back[order], at[order]
        if not len(back):
            return
        to, starts, many = np.unique(back, return_index=True, return_counts=True)
        place = np.repeat(size[to], many) + np.arange(len(back)) - np.repeat(starts, many)
        fits = np.repeat(size[to] + many <= most, many)
        near[back[fits], place[fits]] = at[fits]
        size[to] += many
        full = np.flatnonzero(size[to] > most)
        if not len(full):
            return
        row = np.repeat(np.arange(len(to)), many)
        number = np.full(len(to), -1)
        number[full] = np.arange(len(full))
        have = np.full((len(full), int(size[to[full]].max())), -1)
        have[:, :most] = near[to[full]]
        have[number[row[~fits]], place[~fits]] = at[~fits]
        cos = np.where(have >= 0, np.einsum("ijk,ik->ij", self.x[have], self.x[to[full]]), -np.inf)
        kept = self._choose(*self._ranked(have, cos, have.shape[1]), most * 2 // 3)
        near[to[full]] = -1
        near[to[full], : kept.shape[1]] = kept
        size[to[full]] = (kept >= 0).sum(1)

    def within(self, queries: np.ndarray, least: float, width: int) -> Iterator[np.ndarray]:
        """For each query the nodes whose cosine with it is `least` or more, as far as a beam meets them or their like
        neighbours."""
        for a in range(0, len(queries), TOGETHER):
            q = queries[a : a + TOGETHER]
            at = np.full(len(q), self.entry)
            for level in range(int(self.level[self.entry]), 0, -1):
                at = self.beams(q, at, 1, level)[0][:, 0]
            *_, seen, met = self.beams(q, at, width, 0, least)
            rows, nodes = (np.concatenate([m[i] for m in met]) for i in range(2))
            front = rows, nodes
            while len(front[0]):  # a crowd may be larger than the beam: go on along links that stay within reach
                row, new = self._unseen(front[0], self.near[0][front[1]], seen)
                like = self._cos(new, q, row) >= least
                front = row[like], new[like]
                rows, nodes = np.append(rows, front[0]), np.append(nodes, front[1])
            order = np.lexsort((nodes, rows))
            yield from np.split(nodes[order], np.searchsorted(rows[order], np.arange(1, len(q))))


def all_within(x: np.ndarray, queries: np.ndarray, least: float) -> Iterator[np.ndarray]:
    """The nodes whose cosine with a query is `least` or more, for each query, by comparing all."""
    for at in range(0, len(queries), BLOCK):
        near = queries[at : at + BLOCK] @ x.T >= least
        yield from (np.flatnonzero(r) for r in near)


def audited_beam(graph: Graph, least: float, seed: int = 9) -> int | None:
    """The first width, doubling, whose answers to the audit's queries have RECALL of the links found by comparing all;
    None if there is none, or if all vectors were compared before there were enough queries with links.

    A query's match with itself is no link. Queries with up to FEW links and those with more are held apart, and
    each query counts as one, so neither a crowd nor vectors without links make up for what pairs miss.
    """
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(graph.x))
    few: list[tuple[int, int]] = []
    many: list[tuple[int, int]] = []
    crowded = 0  # vectors compared so far that have many links
    for i, found in zip(order.tolist(), all_within(graph.x, graph.x[order], least), strict=True):
        links = int((found != i).sum())
        if 0 < links <= FEW:
            few.append((i, links))
        elif links:
            crowded += 1
            if len(many) < AUDIT:
                many.append((i, links))
        if len(few) >= AUDIT and (crowded >= AUDIT or not crowded):
            break
    else:
        return None
    width = BEAM
    while width <= WIDEST:
        if all(np.mean([(found != i).sum() / n for (i, n), found in zip(kind, graph.within(graph.x[[i for i, _ in kind]], least, width), strict=True)]) >= RECALL for kind in (few, many) if kind):
            return width
        width *= 2
    return None


class _Shard:
    """One shard's graph and what its queries have found."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray, least: float):
        self.ids, self.weights, self.raw, self.least = ids, weights, vectors, least
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.graph = Graph(vectors / self.norms[:, None])
        # a little below, as unit vectors are rounded; what is found is then verified
        self.width = audited_beam(self.graph, least - 1e-9)
        self.root = np.arange(len(ids))

    def _within(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        if self.width is None:
            return all_within(self.graph.x, unit, self.least - 1e-9)
        return self.graph.within(unit, self.least - 1e-9, self.width)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def query(self, ids: np.ndarray, vectors: np.ndarray, own: bool) -> pa.RecordBatch:
        """(id, weight, null) for each query with links, and (id, 0, other) for links that join what wasn't joined.

        A link between own vectors of up to FEW links each counts for both, whichever of them found it.
        """
        out: list[tuple[int, int, int | None]] = []
        few: dict[int, set[int]] = {}
        many: set[int] = set()
        norms = np.sqrt((vectors * vectors).sum(1))
        for k, (name, v, norm, found) in enumerate(zip(ids.tolist(), vectors, norms, self._within(vectors / norms[:, None]), strict=True)):
            cos = (self.raw[found] * v).sum(1) / (self.norms[found] * norm)
            found = found[cos >= self.least]
            if own:
                found = found[found != k]
                if len(found) > FEW:
                    many.add(k)
                elif len(found):
                    few[k] = set(found.tolist())
            if len(found):
                out.append((name, int(self.weights[found].sum()), None))
                first = k if own else int(found[0])
                if not own:
                    out.append((name, 0, int(self.ids[first])))
                for j in found.tolist():
                    a, b = self._find(first), self._find(j)
                    if a != b:
                        self.root[b] = a
                        out.append((name, 0, int(self.ids[j])))
        for k, mine in few.items():
            out += [(int(ids[j]), int(self.weights[k]), None) for j in mine if j not in many and k not in few.get(j, ())]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)], ["cid", "weight", "other"])


def _search(least: float):
    """Rows come sorted by shard, its own vectors first; then come other shards' as queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def built() -> _Shard:
            return _Shard(*(np.concatenate([h[i] for h in held]) for i in range(3)), least)

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "shard")), strict=True))
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            ids, weights = batch.column("cid").to_numpy(), batch.column("n").to_numpy()
            edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or guest[i] != guest[i - 1]] + [len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                vectors = batch.column("embedding").slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b - a, -1)
                if keys[a] != now:
                    if held:
                        shard = built()
                        yield shard.query(shard.ids, shard.raw, True)
                    now, shard, held = keys[a], None, []
                if not guest[a]:
                    held.append((ids[a:b], vectors, weights[a:b]))
                    continue
                if held:
                    shard, held = built(), []
                    yield shard.query(shard.ids, shard.raw, True)
                if shard is not None:  # else no vector of the label is at home here
                    yield shard.query(ids[a:b], vectors, False)
        if held:
            shard = built()
            yield shard.query(shard.ids, shard.raw, True)

    return run


def near_vectors(vectors: DataFrame, least: float = COSINE, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows link when their labels are equal and not null and their cosine, in double precision, is `least` or more.
    Vectors that are null, zero, or hold null or non-finite components, link with nothing, nor do vectors of
    unequal lengths. Equal vectors of a label are one node with a weight, so their number adds no work.
    component_id is the smallest vec_id that links reach; a null vec_id is smallest only if all are null, and
    its row is kept if it stands alone. A repeated vec_id is a row of its own; all rows with a component's
    smallest vec_id are kept. A label's nodes are dealt to shards of about `shard` by a hash, and every node
    queries every shard, its own when that is built. Other columns are ignored.
    """
    ship(vectors.sparkSession)
    rows = with_row_key(vectors, "vec_id", "embedding", "label", key="vec_id")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.select("rid", "did", "vec_id", "embedding", "label", sound.alias("sound"))
    grouped = rows.filter("sound").groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    nodes = staged(grouped.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "nodes")
    counts = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).alias("shards"))
    dealt = nodes.join(counts, ["label", "dim"]).withColumn("home", F.pmod(F.xxhash64("cid"), F.col("shards")))
    sent = dealt.select("label", "dim", "cid", "n", "embedding", "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")).withColumn("guest", F.col("home") != F.col("shard"))
    key = ("label", "dim", "shard")
    found = sent.repartition(*key).sortWithinPartitions(*key, "guest", "cid").select(*key, "guest", "cid", "n", "embedding").mapInArrow(_search(least), "cid long, weight long, other long")
    found = staged(found, "found")
    root = components(found.filter("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    weight = found.groupBy("cid").agg(F.sum("weight").alias("weight"))
    joined = nodes.join(weight, "cid", "left").join(root, nodes.cid == root.v, "left").select("cid", "label", "embedding", "n", "least", F.coalesce("weight", F.lit(0)).alias("weight"), F.coalesce("root", "cid").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    known = joined.join(smallest, "root").select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.col("n") - 1 + F.col("weight")).alias("links"), "component")
    both = rows.join(known, (rows.label == known.l) & (rows.embedding == known.e) & rows.sound, "left")
    return both.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("links").isNotNull(), F.col("component")).otherwise(F.col("vec_id")).alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def brute_force(rows: list[tuple], least: float = COSINE) -> dict[int, tuple[int, int]]:
    """vec_id to (n_links, component_id) by comparing all pairs; rows are (vec_id, vector, label). For tests."""
    sound = [(i, np.array(v, float), label) for i, v, label in rows if v is not None and label is not None and None not in v]
    sound = [r for r in sound if np.isfinite(r[1]).all() and r[1].any()]
    root = {r[0]: r[0] for r in rows}
    links = dict.fromkeys(root, 0)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for kind in {(r[2], len(r[1])) for r in sound}:
        mine = [r for r in sound if (r[2], len(r[1])) == kind]
        x = np.array([r[1] for r in mine])
        norm = np.sqrt((x * x).sum(1))
        for k, (i, v, _) in enumerate(mine):
            for j in np.flatnonzero((x * v).sum(1) / (norm * norm[k]) >= least):
                if j != k:
                    links[i] += 1
                    low, high = sorted((find(i), find(mine[j][0])))
                    root[high] = low
    return {i: (links[i], find(i)) for i in root}
