"""LM scoring: a causal self-attention model over subword ids, trained in numpy, beside a unigram base over words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm.pack import default_tokenizer, encoder
from litloom.llm.runtime import ship, staged, staged_bytes, with_row_key
from litloom.llm.windows import _batches, word_units

#: Ids in a context window, and how far windows are apart; the ids that two windows share are scored in the first.
WINDOW, STRIDE = 48, 40
#: Classes of ids, of about equal counts. An id's probability is its class's, given all ids before it in the window,
#: times its own in the class, given the class before it.
CLASSES = 64
#: Commonest ids, with an embedding of their own; another id has its class's.
KNOWN = 1024
#: Width of the model and of its inner layer.
WIDTH, INNER = 16, 32
#: Counts of pairs are smoothed by so many of what is expected with less of the context.
SMOOTH = 8.0
#: Rounds that the windows of all training documents are dealt to; after each the partitions' weights are averaged,
#: as whole multiples of 1 / UNIT, whose sums don't depend on their order. A batch of windows is learnt from at all places.
ROUNDS, UNIT, BATCH, RATE = 3, 1 << 20, 128, 3e-3
#: Windows that are scored at a time, so that they stay in a core's cache.
AT_ONCE = 64
#: Pages in which the driver gets the counts of pairs, and ids that are counted at a time.
PAGES, COUNTED = 128, 1 << 22
#: Bytes of staged ids for each bucket of words.
BUCKET_BYTES = 4 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER_ARRAY = np.frombuffer(_LOWER, np.uint8)
#: The tokenizer's own end of text, and the mark before a text's first id; IDS ids come before it.
END = 50256
IDS = START = END + 1


def _capped(logits: np.ndarray) -> None:
    """Bounds logits, so that their exponentials stay finite; seldom needed, and a look is cheaper than the bound."""
    if logits.max(initial=0) > 60:
        np.minimum(logits, 60, out=logits)


class Attention:
    """One block of causal self-attention with a residual inner layer; its logits for the next id's class are added to
    prior ones."""

    def __init__(self, rows: int, classes: int = CLASSES, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.classes = classes
        self.p = {
            "embed": rng.standard_normal((rows, WIDTH)).astype(np.float32) * 0.5, "place": rng.standard_normal((WINDOW, WIDTH)).astype(np.float32) * 0.1,
            "q": normal(WIDTH, WIDTH), "k": normal(WIDTH, WIDTH), "v": normal(WIDTH, WIDTH), "o": normal(WIDTH, WIDTH),
            "in": normal(WIDTH, INNER), "in_b": np.zeros(INNER, np.float32), "out": normal(INNER, WIDTH), "logits": normal(WIDTH, classes) * 0.1, "bias": np.zeros(classes, np.float32),
        }
        self.earlier = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        """q with k, scaled, and v with o: both are small products, so that ids' states are keys and values as they are."""
        p = self.p
        return p["q"] @ p["k"].T * p["q"].dtype.type(1 / np.sqrt(WIDTH)), p["v"] @ p["o"]

    def weigh(self, before: np.ndarray, first: int, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Weights of the classes at each place from `first` on, a row for each place of each window, what a row sums
        to, and the inner states. before: embedding rows of the ids before each place; prior: a row of logits for each place."""
        p = self.p
        b, n = before.shape
        x = p["embed"].take(before, 0)
        x += p["place"][:n]
        asking = x[:, first:].reshape(-1, WIDTH)
        qk, vo = self.folded()
        u = (asking @ qk).reshape(b, n - first, WIDTH)
        s = np.matmul(u, x.transpose(0, 2, 1))
        _capped(s)
        np.exp(s, out=s)
        s *= self.earlier[first:n, :n]
        whole = s @ np.ones((n, 1), s.dtype)
        mixed = np.matmul(s, x)
        mixed /= whole
        mixed = mixed.reshape(-1, WIDTH)
        y = asking + mixed @ vo
        inner = y @ p["in"]
        inner += p["in_b"]
        inner *= inner > 0
        z = y + inner @ p["out"]
        likely = z @ p["logits"]
        likely += p["bias"]
        likely += prior
        _capped(likely)
        np.exp(likely, out=likely)
        return likely, likely @ np.ones(self.classes, likely.dtype), (x, u, s, whole, mixed, y, inner, z)

    def forward(self, before: np.ndarray, first: int, prior: np.ndarray) -> tuple[np.ndarray, tuple]:
        """weigh()'s rows as probabilities, and what backward() needs."""
        likely, total, kept = self.weigh(before, first, prior)
        likely /= total[:, None]
        return likely, kept

    def backward(self, before: np.ndarray, first: int, after: np.ndarray, weight: np.ndarray, likely: np.ndarray, kept: tuple, total: np.ndarray | float = 1.0) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log probability of the classes `after`, one for each row of likely. total: what
        rows of likely are still to be divided by. likely is overwritten.

        Divisions are made where rows are narrow, and sums of rows are products with ones, which take less time.
        """
        p = self.p
        x, u, s, whole, mixed, y, inner, z = kept
        qk, vo = self.folded()
        b, n = before.shape
        scale = p["q"].dtype.type(1 / np.sqrt(WIDTH))
        windows = lambda a: a.reshape(b, -1, WIDTH)
        weight = (weight / weight.sum()).astype(likely.dtype)
        d, ones = likely, np.ones(len(after), likely.dtype)
        d *= (weight / total)[:, None]
        d[np.arange(len(after)), after] -= weight
        g = {"logits": z.T @ d, "bias": ones @ d}
        dz = d @ p["logits"].T
        dinner = dz @ p["out"].T
        dinner *= inner > 0
        g |= {"out": inner.T @ dz, "in": y.T @ dinner, "in_b": ones @ dinner}
        dy = dz
        dy += dinner @ p["in"].T
        dvo = mixed.T @ dy
        g |= {"v": dvo @ p["o"].T, "o": p["v"].T @ dvo}
        dmixed = dy @ vo.T
        dmixed /= whole.reshape(-1, 1)  # so that s needn't be
        ds = np.matmul(windows(dmixed), x.transpose(0, 2, 1))
        ds -= ((dmixed * mixed) @ np.ones(WIDTH, ds.dtype)).reshape(b, -1, 1)
        ds *= s
        du = np.matmul(ds, x).reshape(-1, WIDTH)
        dqk = x[:, first:].reshape(-1, WIDTH).T @ du * scale
        g |= {"q": dqk @ p["k"], "k": dqk.T @ p["q"]}
        dx = np.matmul(s.transpose(0, 2, 1), windows(dmixed))
        dx += np.matmul(ds.transpose(0, 2, 1), u)
        dy += du @ qk.T
        dx[:, first:] += windows(dy)
        g["place"] = np.zeros_like(p["place"])
        g["place"][:n] = dx.sum(0)
        g["embed"] = np.zeros_like(p["embed"])
        order = np.argsort(before.ravel().astype(np.int16), kind="stable")
        rows, edges = np.unique(before.ravel()[order], return_index=True)
        g["embed"][rows] = np.add.reduceat(dx.reshape(-1, WIDTH)[order], edges)
        return g


class Adam:
    """Steps of a model's weights, in place."""

    def __init__(self, net: Attention, rate: float = RATE):
        self.net, self.rate, self.steps = net, rate, 0
        self.first, self.second = ({n: np.zeros_like(a) for n, a in net.p.items()} for _ in range(2))

    def step(self, before: np.ndarray, first: int, prior: np.ndarray, after: np.ndarray, weight: np.ndarray) -> float:
        """One step on these windows; returns their loss before it."""
        self.steps += 1
        likely, total, kept = self.net.weigh(before, first, prior)
        loss = -float((np.log(likely[np.arange(len(after)), after] / total) * weight).sum() / weight.sum())
        for n, g in self.net.backward(before, first, after, weight, likely, kept, total).items():
            first_, second = self.first[n], self.second[n]
            first_ += 0.1 * (g - first_)
            second += 0.01 * (g * g - second)
            self.net.p[n] -= self.rate * (first_ / (1 - 0.9**self.steps)) / (np.sqrt(second / (1 - 0.99**self.steps)) + 1e-8)
        return loss


@dataclass(frozen=True)
class Model:
    """The attention model and what counts over the training texts say.

    of: each id's class; START's is the last. row: their embedding rows. follow: log of the class's share after an id,
    a row for each id and START, which the attention model's logits are added to. within: log10 of an id's share of its
    class after a class, a row for each class and START.
    """

    net: Attention
    of: np.ndarray
    row: np.ndarray
    follow: np.ndarray
    within: np.ndarray


def classes_of(counts: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Each id's class, of about equal counts with ids in order of count, and START's; and each one's embedding row."""
    order = np.argsort(-counts, kind="stable")
    smooth = counts + 1.0
    upto = np.cumsum(smooth[order])
    of = np.full(len(counts) + 1, classes)
    of[order] = np.minimum(((upto - smooth[order] / 2) / upto[-1] * classes).astype(np.int64), classes - 1)
    row = KNOWN + of
    row[order[:KNOWN]] = np.arange(min(KNOWN, len(order)))
    return of, row


def pair_models(counts: np.ndarray, of: np.ndarray, after_id: np.ndarray, after_class: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(follow, within) from the counts of (id before, class) and of (class before, id); each backs off to less context:
    an id before to its class, and that to none."""
    ids, classes = len(counts), after_id.shape[1]
    smooth = counts + 1.0
    whole = np.maximum(np.bincount(of[:-1], smooth, classes), 1e-6)  # a class may be empty
    pairs = np.zeros((classes + 1, classes))
    np.add.at(pairs, of, after_id)
    by_class = (pairs + SMOOTH * whole / whole.sum()) / (pairs.sum(1, keepdims=True) + SMOOTH)
    follow = np.log((after_id + SMOOTH * by_class[of]) / (after_id.sum(1, keepdims=True) + SMOOTH)).astype(np.float32)
    within = np.empty((classes + 1, ids), np.float32)
    for c in range(classes + 1):
        within[c] = np.log10((after_class[c] + SMOOTH * smooth / whole[of[:-1]]) / (pairs[c] + SMOOTH)[of[:-1]])
    return follow, within


def window_starts(n: int) -> np.ndarray:
    """Where the windows over n ids start: a window's first WINDOW - STRIDE ids were scored in the one before."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def _take(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, after, inside) of the windows that start there: the ids before and at each place, and which are the text's."""
    padded = np.concatenate(([START], ids, np.zeros(WINDOW, np.int64)))
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < len(ids)
    at = np.minimum(at, len(ids))
    return padded[at], padded[at + 1], inside


def training_windows(texts: list[np.ndarray], turn: int, turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, after, inside) of each text's windows, WINDOW apart, whose number in the text is `turn` modulo turns."""
    made = [_take(ids, np.arange(turn * WINDOW, len(ids), turns * WINDOW)) for ids in texts]
    before, after, inside = (np.concatenate([m[i] for m in made]) for i in range(3))
    return before, after, inside


def _learn(model, turn: int):
    """A partition's weights after a step for each BATCH of its windows of this round, times their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said: Model = model.value
        net = Attention(len(said.net.p["embed"]), said.net.classes)
        net.p = {n: a.copy() for n, a in said.net.p.items()}
        adam, rng, seen = Adam(net), np.random.Generator(np.random.PCG64(turn)), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                texts = [np.frombuffer(x.as_py(), "<u2").astype(np.int64) for x in whole.column("ids").slice(at, 256)]
                # texts take turns as to which round has their first window, so that short ones fall to all rounds
                made = [training_windows(texts[i::ROUNDS], (turn + i) % ROUNDS, ROUNDS) for i in range(min(ROUNDS, len(texts)))]
                before, after, inside = (np.concatenate([m[i] for m in made]) for i in range(3))
                order = rng.permutation(len(before))
                for a in range(0, len(order), BATCH):
                    i = order[a : a + BATCH]
                    adam.step(said.row[before[i]], 0, said.follow.take(before[i].ravel(), 0), said.of[after[i].ravel()], inside[i].ravel().astype(np.float32))
                seen += len(order)
        if seen:
            flat = np.concatenate([net.p[n].ravel() for n in sorted(net.p)])
            sums = np.rint(flat.astype(float) * UNIT).astype(np.int64) * seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(flat))), pa.array(np.append(seen, sums))], ["i", "v"])

    return run


def learn_all(model: Model, train: DataFrame) -> int:
    """Trains the attention model, in place, on every id of every row of train, in ROUNDS passes that share the windows
    out, each learnt from at all of its places; returns the windows' number.

    In a round each partition goes on from the same weights with its own windows, and the weights that they come
    to are averaged by the windows they stand for. The driver gets a row for each weight, whatever the input.
    """
    spark, windows, net = train.sparkSession, 0, model.net
    for turn in range(ROUNDS):
        said = spark.sparkContext.broadcast(model)
        got = train.select("ids").mapInArrow(_learn(said, turn), "i long, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38, 0)")).cast("double").alias("v")).toPandas().sort_values("i")["v"].to_numpy()
        said.destroy()
        if not len(got):
            continue
        flat, at = got[1:] / (float(UNIT) * got[0]), 0
        for n in sorted(net.p):
            net.p[n] = flat[at : at + net.p[n].size].reshape(net.p[n].shape).astype(np.float32)
            at += net.p[n].size
        windows += int(got[0])
    return windows


def _ids(path: str):
    """Texts as the ids of their lower-cased words with single spaces, and then END."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out = []
                for text in batch.column("text").to_pylist():
                    words = b" ".join(text.encode().translate(_LOWER).split()).decode()
                    out.append(np.append(np.frombuffer(encode(words), "<u4"), END).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "did", "doc_id", "held_out")), pa.array(out, pa.binary())], ["rid", "did", "doc_id", "held_out", "ids"])

    return run


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for ids in batch.column("ids"):
            total += np.bincount(np.frombuffer(ids.as_py(), "<u2"), minlength=1 << 16)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])


def _count_pairs(of: np.ndarray, classes: int):
    """Counts of (id before, class) and then of (class before, id), as places in one array, START being before all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((IDS + 1) * classes, np.int64), np.zeros((classes + 1) * IDS, np.int64)]
        held: list[np.ndarray] = []

        def count() -> None:
            ids = np.concatenate(held)
            before = np.concatenate(([START], ids[:-1]))
            before[np.cumsum([len(h) for h in held])[:-1]] = START
            for counts, place in zip(total, (before * classes + of[ids], of[before] * IDS + ids), strict=True):
                got = np.bincount(place)
                counts[: len(got)] += got
            held.clear()

        size = 0
        for batch in batches:
            for x in batch.column("ids"):
                held.append(np.frombuffer(x.as_py(), "<u2").astype(np.int64))
                size += len(held[-1])
                if size >= COUNTED:
                    count()
                    size = 0
        if held:
            count()
        base = 0
        for counts in total:
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(base + some), pa.array(counts[some])], ["i", "n"])
            base += len(counts)

    return run


def _pages(size: int):
    """Counts (i, n) as PAGES pages, which take turns along them; a page's come to one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for b in batches:
            place, page = np.divmod(b.column("i").to_numpy(), PAGES)
            n = b.column("n").to_numpy()
            for p in np.unique(page).tolist():
                pages.setdefault(p, np.zeros(size, "<f4"))[place[page == p]] = n[page == p]
        yield pa.RecordBatch.from_arrays([pa.array(list(pages), pa.int64()), pa.array([x.tobytes() for x in pages.values()], pa.binary())], ["page", "counts"])

    return run


def train_model(ids: DataFrame, classes: int = CLASSES) -> Model:
    """The model, from the rows of ids that aren't held out: all their counts, and all their windows."""
    train = ids.filter(~F.col("held_out"))
    counted = train.select("ids").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row for each id at most
    counts = np.zeros(IDS)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    of, row = classes_of(counts, classes)
    pairs = train.select("ids").mapInArrow(_count_pairs(of, classes), "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    many = (IDS + 1) * classes + (classes + 1) * IDS
    flat = np.zeros((-(-many // PAGES), PAGES), np.float32)
    for page in pairs.repartition(F.col("i") % PAGES).mapInArrow(_pages(len(flat)), "page long, counts binary").collect():  # 4 bytes for each pair of an id and a class
        flat[:, page.page] = np.frombuffer(page.counts, "<f4")
    flat = flat.ravel()[:many]
    cut = (IDS + 1) * classes
    follow, within = pair_models(counts, of, flat[:cut].reshape(IDS + 1, classes).astype(float), flat[cut:].reshape(classes + 1, IDS))
    model = Model(Attention(KNOWN + classes + 1, classes), of, row, follow, within)
    learn_all(model, train)
    return model


def log_probabilities(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """The log10 probability of each text's ids, by its windows, many of them at a time."""
    flat = np.concatenate(texts)
    lens = np.array([len(t) for t in texts])
    edges = np.cumsum(lens) - lens
    before = np.concatenate(([START], flat[:-1]))
    before[edges] = START
    total = np.add.reduceat(model.within[model.of[before], flat].astype(float), edges)
    starts = [window_starts(n) for n in lens]
    taken = [_take(ids, s) for ids, s in zip(texts, starts, strict=True)]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    before, after, inside = (np.concatenate([t[i] for t in taken]) for i in range(3))
    later = np.concatenate([s > 0 for s in starts])
    for first, some in ((0, np.flatnonzero(~later)), (WINDOW - STRIDE, np.flatnonzero(later))):
        for a in range(0, len(some), AT_ONCE):
            i = some[a : a + AT_ONCE]
            likely, whole, _ = model.net.weigh(model.row[before[i]], first, model.follow.take(before[i, first:].ravel(), 0))
            got = np.log10((likely[np.arange(len(likely)), model.of[after[i, first:].ravel()]] / whole).astype(float))
            total += np.bincount(owner[i], (got.reshape(len(i), -1) * inside[i, first:]).sum(1), len(texts))
    return total


def _score(model):
    """The log10 probability of every text's ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                texts = [np.frombuffer(x.as_py(), "<u2").astype(np.int64) for x in batch.column("ids")]
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("did"), pa.array(log_probabilities(model.value, texts)), pa.array([len(t) for t in texts], pa.int64())], ["rid", "did", "score", "n_ids"])

    return run


def _deal_words(buckets: int):
    """For each batch of texts and bucket of words: the distinct words' hashes, their counts in training texts, and
    which texts have them how often. The texts' keys go with bucket 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _batches(batches):
            units, firsts = word_units(_LOWER_ARRAY[data], offsets)
            n = np.diff(firsts)
            held = rows.column("held_out").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n), dtype=np.uint32), n)
            # One sort by the hashes' high bits, which also give the bucket, and place. Where these are equal, but
            # not the hashes, a word may come up twice, which the bucket's sums don't mind.
            bits = np.uint64(max(1, len(units).bit_length()))
            order = (np.sort(units >> bits << bits | np.arange(len(units), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            units, row = units[order], row[order]
            edge = np.flatnonzero(np.append(True, (units[1:] != units[:-1]) | (row[1:] != row[:-1]))) if len(units) else np.zeros(0, int)
            times = np.diff(np.append(edge, len(units))).astype(np.uint32)
            units, row = units[edge], row[edge]
            bucket = ((units >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            keys = rows.column("rid").to_numpy().tobytes(), rows.column("did").to_numpy().tobytes()
            name = zlib.crc32(keys[1], zlib.crc32(keys[0])) << 31 | len(n) & 0x7FFFFFFF
            lead = int(np.frombuffer(keys[0], np.int64)[0])
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for b in range(buckets):
                s = slice(cuts[b], cuts[b + 1])
                if s.start == s.stop and b:
                    continue
                w, r, t = units[s], row[s], times[s]
                e = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, int)
                trained = np.add.reduceat(np.where(held[r], 0, t).astype(np.int64), e) if len(w) else np.zeros(0, np.int64)
                some = np.diff(np.append(e, len(w)))
                out.append((b, w[e].tobytes(), trained.astype("<u4").tobytes(), some.astype("<u4").tobytes(), r.astype("<u4").tobytes(), t.tobytes(), keys[0] if not b else None, keys[1] if not b else None, held.tobytes() if not b else None, n.astype("<i8").tobytes() if not b else None))
            many = len(out)
            arrays = [pa.array([name] * many, pa.int64()), pa.array([lead] * many, pa.int64()), pa.array([len(n)] * many, pa.int64()), pa.array([o[0] for o in out], pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array([o[i] for o in out], pa.binary()) for i in range(1, 10)], [c for c, _ in _DEALT])

    return run


_DEALT = [("name", "long"), ("lead", "long"), ("texts", "long"), ("bucket", "int"), *((c, "binary") for c in ("words", "trained", "some", "row", "times", "rids", "dids", "held", "n_words"))]
_PART = "name long, lead long, texts long, sums binary, known binary, rids binary, dids binary, held binary, n_words binary, tokens long, kinds long"


def _sum_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket has all batches' shares of its words, so its counts are whole; then every text's sum over them."""
    def settle(held: list[dict]) -> pa.RecordBatch:
        words = [np.frombuffer(h["words"], np.uint64) for h in held]
        distinct, where = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(where, np.concatenate([np.frombuffer(h["trained"], "<u4") for h in held]), len(distinct))
        gain, seen = np.log10(count + 1), count > 0
        out = {c: [] for c in ("sums", "known")}
        at = 0
        for h, w in zip(held, words, strict=True):
            here = np.repeat(where[at : at + len(w)], np.frombuffer(h["some"], "<u4"))
            at += len(w)
            row, times = np.frombuffer(h["row"], "<u4"), np.frombuffer(h["times"], "<u4")
            out["sums"].append(np.bincount(row, gain[here] * times, h["texts"]).tobytes())
            out["known"].append(np.bincount(row, seen[here] * times, h["texts"]).astype("<u4").tobytes())
        whole = {c: [h[c] for h in held] for c in ("name", "lead", "texts", "rids", "dids", "held", "n_words")} | out
        whole |= {"tokens": [int(count.sum())] + [0] * (len(held) - 1), "kinds": [int(seen.sum())] + [0] * (len(held) - 1)}
        kinds = {"name": pa.int64(), "lead": pa.int64(), "texts": pa.int64(), "tokens": pa.int64(), "kinds": pa.int64()}
        order = ["name", "lead", "texts", "sums", "known", "rids", "dids", "held", "n_words", "tokens", "kinds"]
        return pa.RecordBatch.from_arrays([pa.array(whole[c], kinds.get(c, pa.binary())) for c in order], order)

    held: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c, _ in _DEALT}
            if held and held[0]["bucket"] != row["bucket"]:
                yield settle(held)
                held = []
            held.append(row)
    if held:
        yield settle(held)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of texts' sums over all buckets; rows come sorted by batch."""
    def whole(held: list[dict]) -> pa.RecordBatch:
        keys = next(h for h in held if h["rids"] is not None)
        sums = sum(np.frombuffer(h["sums"], float) for h in held)
        known = sum(np.frombuffer(h["known"], "<u4").astype(np.int64) for h in held)
        arrays = [np.frombuffer(keys["rids"], np.int64), np.frombuffer(keys["dids"], np.int64), np.frombuffer(keys["n_words"], np.int64), known, sums]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["rid", "did", "n_words", "known", "gain"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["name"], held[0]["lead"]) != (row["name"], row["lead"]):
                yield whole(held)
                held = []
            held.append(row)
    if held:
        yield whole(held)


def word_scores(rows: DataFrame, buckets: int) -> tuple[DataFrame, int, int]:
    """(rid, did, n_words, known, gain) of every row, and the training words' number and kinds.

    gain is the sum over words of log10(count + 1). Words are compared by 64-bit hashes.
    """
    dealt = rows.select("rid", "did", "held_out", "text").mapInArrow(_deal_words(buckets), ", ".join(f"{c} {t}" for c, t in _DEALT))
    parts = staged(dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_sum_bucket, _PART), "word-sums")
    words, kinds = parts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    sums = parts.drop("tokens", "kinds").repartition("name", "lead").sortWithinPartitions("name", "lead").mapInArrow(_gather, "rid long, did long, n_words long, known long, gain double")
    return sums, words, kinds


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of doc_id as text, modulo 7, is 2. A null one is as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def score_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_ids of every row.

    A text's tokens are its words, A-Z lower-cased, and one end; base_score is their add-one unigram log10
    probability, from the counts in texts that aren't held out. score is the log10 probability of the text's
    subword ids and their end by the model: of each id's class, given the ids before it in its window, and of the
    id in its class, given the class before it. Null, empty and blank texts are their end alone. Rows with a repeated or null
    doc_id are scored, and learnt from, as rows of their own. An empty table gives no rows. Other columns are
    ignored. Windows overlap by WINDOW - STRIDE ids, so an id is scored once with that many before it or more,
    but for those at the start of a text.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = with_row_key(docs, "doc_id", "text").select("rid", "did", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    ids = staged(rows.select("rid", "did", "doc_id", "held_out", "text").mapInArrow(_ids(tokenizer or default_tokenizer()), "rid long, did long, doc_id long, held_out boolean, ids binary"), "ids")
    model = spark.sparkContext.broadcast(train_model(ids))
    scored = ids.select("rid", "did", "ids").mapInArrow(_score(model), "rid long, did long, score double, n_ids long")
    # A task holds a bucket, so their number follows the input.
    sums, words, kinds = word_scores(rows, max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), staged_bytes(ids) // BUCKET_BYTES))
    ends = ids.filter(~F.col("held_out")).count()
    tokens, kinds = words + ends, kinds + (ends > 0)
    total = F.col("n_words") + 1
    base = F.col("gain") + float(np.log10(ends + 1)) - total * float(np.log10(tokens + kinds + 1))
    joined = ids.select("rid", "did", "doc_id", "held_out").join(sums, ["rid", "did"]).join(scored, ["rid", "did"])
    return joined.select("doc_id", "held_out", total.alias("n_tokens"), (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "n_ids")


def brute_force_base(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """doc_id to (held_out, n_tokens, n_known, train_tokens, base_score); for tests."""
    from collections import Counter

    texts = {i: (t or "").encode().translate(_LOWER).split() + [None] for i, t in rows}
    out_of = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i, t in texts.items() if not out_of[i] for w in t)
    n, v = sum(count.values()), len(count)
    return {i: (out_of[i], len(t), sum(w in count for w in t), n, float(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in t))) for i, t in texts.items()}
