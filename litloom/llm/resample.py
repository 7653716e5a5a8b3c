"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.llm.runtime import as_scan, keep_rows, ship, smallest, staged, with_row_key
from litloom.llm.windows import Spans, _batches, _mix, word_units

#: Buckets of the hashed n-grams; the models are two arrays of this length.
BUCKETS = 1 << 21
#: Buckets whose ratios the driver gets at once.
PAGE = 1 << 16
#: Labelled documents of each kind that the target model and the cut are fitted on, at most: those whose hashed
#: doc_id is smallest. Raw counts, weights and the top-k cover all documents.
FIT = 20_000
#: The cut is chosen on weights of labelled documents by the target texts of the other folds, so that it is one for texts
#: that the target model hasn't seen.
FOLDS = 4
#: Share of target texts that a cut may leave out, where few labels can't tell all of the others apart.
LOST = 0.02
#: A bucket's log ratio is shrunk by z / (z + SHRINK), where z is twice the log likelihood ratio of its count in target
#: against what raw text leads to expect; so what is rare in both says little, and every bucket has its say.
SHRINK = 20.0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BINS = 4096


#: Fixed value: classes of characters in a word's shape: small, capital, digit, beyond ASCII; others are themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 128


def hashed_ngrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of every text's features, text by text, and where each text starts.

    n-grams are words, A-Z lower-cased, the shapes of words and of pairs of words (runs of like characters as
    one), and pairs of equal words as such. Pairs of words themselves would fill the buckets with what is rare. Each
    n-gram of a text is a feature once, and once more for being there 2, 4, 8, ... times, so a text says how often,
    but a long repetition doesn't drown the rest.
    """
    units, firsts = word_units(_LOWER[data], offsets)
    n = np.diff(firsts)
    row = np.repeat(np.arange(len(n)), n)
    inside = row[:-1] == row[1:] if len(row) else np.zeros(0, bool)
    same = row[:-1][inside & (units[:-1] == units[1:])] if len(row) else row
    shape = _SHAPE[data]
    first = np.append(True, shape[1:] != shape[:-1]) if len(data) else np.zeros(0, bool)
    starts = offsets[:-1][offsets[:-1] < len(data)]
    first[starts] = True
    runs = np.flatnonzero(first)
    shapes, _ = word_units(shape[runs], np.searchsorted(runs, offsets))
    at = np.arange(max(0, len(units) - 1))
    two = Spans(shapes, 1).of(at, at + 2, at)[inside]
    rows = np.concatenate((row, row[:-1][inside], row, same))
    grams = np.concatenate((units, two, shapes ^ np.uint64(0x5851F42D4C957F2D), np.full(len(same), np.uint64(0x2545F4914F6CDD1D))))
    key = np.stack((rows.astype(np.uint64), grams))
    order = np.lexsort(key[::-1])
    rows, grams = rows[order], grams[order]
    edge = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1]))) if len(rows) else np.zeros(0, int)
    count = np.diff(np.append(edge, len(rows)))
    rows, grams = rows[edge], grams[edge]
    out_rows, out = [rows], [grams]
    level = 1
    while len(rows):
        often = count >= 1 << level
        rows, grams, count = rows[often], grams[often], count[often]
        out_rows.append(rows)
        out.append(_mix(grams + np.uint64(level)))
        level += 1
    rows = np.concatenate(out_rows)
    order = np.argsort(rows, kind="stable")
    return (_mix(np.concatenate(out)[order]) % np.uint64(buckets)).astype(np.int64), np.searchsorted(rows[order], np.arange(len(n) + 1))


def _count(buckets: int):
    """Counts of a partition's features, as (bucket, n); bucket -1 counts its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(buckets, np.int64), 0
        for rows, data, offsets in _batches(batches):
            total += np.bincount(hashed_ngrams(data, offsets, buckets)[0], minlength=buckets)
            texts += rows.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], texts))], ["bucket", "n"])

    return run


def _weigh(model, buckets: int):
    """Each text's features and their summed log ratios."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.append(model.value, np.float32(0))
        for rows, data, offsets in _batches(batches):
            at, firsts = hashed_ngrams(data, offsets, buckets)
            n = np.diff(firsts)
            # reduceat gives an entry for an empty text too; it is set to 0 afterwards
            sums = np.add.reduceat(np.append(table[at], np.float32(0)).astype(float), firsts[:-1]) if len(n) else np.zeros(0)
            keep = [rows.column(c) for c in rows.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(n.astype(np.int64)), pa.array(np.where(n > 0, sums, 0.0))], [c for c in rows.schema.names if c != "text"] + ["n_ngrams", "log_weight"])

    return run


def _counts(texts: DataFrame, name: str, buckets: int) -> DataFrame:
    """bucket and its count, as name; bucket -1 counts texts."""
    return texts.mapInArrow(_count(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").cast("double").alias(name))


def log_ratio(target: np.ndarray, n_target: float, raw: np.ndarray, n_raw: float) -> np.ndarray:
    """log(target / raw) of each bucket, of either sign, shrunk by the evidence that the two models differ there."""
    expected = n_target * (raw + 0.5) / (n_raw + 1)
    evidence = 2 * (target * np.log(np.maximum(target, 1) / np.maximum(expected, 1e-9)) - target + expected)
    evidence = np.maximum(evidence, 0)
    return (np.log((target + 0.5) / (expected + 0.5)) * evidence / (evidence + SHRINK)).astype(np.float32)


def _ratios(n_target: list[float], n_raw: float):
    """The log ratios of each page of PAGE buckets, by the target texts of all folds (part -1) and of all but each one; a
    page's counts come to one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            folds, raw = [b.column(f"target_{f}").to_numpy() for f in range(FOLDS)], b.column("raw").to_numpy()
            page, place = np.divmod(b.column("bucket").to_numpy(), PAGE)
            for part in range(-1, FOLDS):
                others = [f for f in range(FOLDS) if f != part]
                got = log_ratio(sum(folds[f] for f in others), sum(n_target[f] for f in others), raw, n_raw)
                for p in np.unique(page).tolist():
                    pages.setdefault((p, part), np.zeros(PAGE, "<f4"))[place[page == p]] = got[page == p]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pages], pa.int64()), pa.array([part for _, part in pages], pa.int32()), pa.array([x.tobytes() for x in pages.values()], pa.binary())], ["page", "part", "ratios"])

    return run


@dataclass(frozen=True)
class Models:
    """log(target / raw) of each bucket, and the weight below which text is unlike target."""

    ratio: np.ndarray
    cut: float


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the fewest labelled documents on the wrong side, each kind counting as one whole, among those that
    leave out at most LOST of the good ones."""
    if not len(good) or not len(bad):
        return float("-inf")
    values = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([values[0] - 1], (values[1:] + values[:-1]) / 2))
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    cuts, lost = cuts[lost <= LOST], lost[lost <= LOST]
    wrong = lost + 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    least = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(cuts[least[len(least) // 2]])


def fit_models(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, fit: int = FIT) -> Models:
    """Target: labelled documents of quality 1 that aren't toxic. Raw: all documents. The cut is held out, by folds."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    kind = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).when((F.col("quality") == 0) | (F.col("toxic") == 1), 0)
    marked = labels.select(F.col("doc_id").alias("did"), kind.alias("good")).filter("good is not null and did is not null").groupBy("did").agg(F.min("good").alias("good"))
    hashed = marked.select(F.xxhash64("did").alias("k"), "did", "good")
    picked = smallest(hashed.filter("good = 1"), "k", fit).union(smallest(hashed.filter("good = 0"), "k", fit)).select("did", "good", F.pmod(F.xxhash64("k"), F.lit(FOLDS)).cast("int").alias("fold"))
    sample = staged(texts.join(picked, "did").select("good", "fold", "text"), "labelled")
    counts = _counts(texts.select("text"), "raw", buckets)
    for f in range(FOLDS):
        counts = counts.join(_counts(sample.filter(f"good = 1 and fold = {f}").select("text"), f"target_{f}", buckets), "bucket", "left")
    counts = staged(counts.fillna(0), "counts")
    n = counts.filter("bucket = -1").first()
    if n is None:  # no documents
        return Models(np.zeros(buckets, np.float32), float("-inf"))
    n_target = [n[f"target_{f}"] for f in range(FOLDS)]
    paged = staged(counts.filter("bucket >= 0").repartition(F.floor(F.col("bucket") / PAGE)).drop("n").mapInArrow(_ratios(n_target, n.raw), "page long, part int, ratios binary"), "ratios")

    def ratios(part: int) -> np.ndarray:
        out = np.zeros(-(-buckets // PAGE) * PAGE, np.float32)
        for page in paged.filter(F.col("part") == part).toLocalIterator():  # 4 bytes for each bucket
            out[page.page * PAGE : (page.page + 1) * PAGE] = np.frombuffer(page.ratios, "<f4")
        return out[:buckets]

    good, weight = [], []
    for f in range(FOLDS):  # one after the other, so that the driver holds one table at a time
        # A fold that has all target texts is weighed by all of them, as nothing else knows any.
        shared = spark.sparkContext.broadcast(ratios(f if sum(n_target) > n_target[f] else -1))
        weighed = sample.filter(F.col("fold") == f).select("good", "text").mapInArrow(_weigh(shared, buckets), "good int, n_ngrams long, log_weight double")
        scored = weighed.select("good", "log_weight").toPandas()  # 2 * fit rows at most, over all folds
        shared.destroy()
        good.append(scored["good"].to_numpy() == 1)
        weight.append(scored["log_weight"].to_numpy())
    good, weight = np.concatenate(good), np.concatenate(weight)
    return Models(ratios(-1), best_cut(weight[good], weight[~good]))


def top_k(scored: DataFrame, k: int, key: str = "key") -> DataFrame:
    """scored, staged, with `kept`: the k rows of largest key; ties by rid and did. Exact, by counting keys in ever
    finer bins; the driver sees a row for each bin."""
    low, high = scored.agg(F.min(key), F.max(key)).first()
    if low is None or k <= 0:
        return scored.withColumn("kept", F.lit(False))
    above, left = None, k
    while True:
        width = (high - low) / _BINS
        if not width or low + width == low or low + (_BINS - 1) * width >= high:
            break
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(_BINS - 1))
        counts = sorted(((r.b, r.n, r.low, r.high) for r in scored.filter(F.col(key).between(low, high)).groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()), reverse=True)
        for _, n, first, last in counts:
            if n >= left:
                break
            left -= n
        else:
            return scored.withColumn("kept", F.lit(True))
        low, high, above = first, last, last
        if n <= 10_000 or low == high:
            break
    from pyspark.sql import Window as W

    # The last bin: 10,000 rows, or equal keys only, which a hash of the row then tells apart.
    edge = scored.filter(F.col(key).between(low, high))
    if low < high:
        ranked = edge.withColumn("place", F.row_number().over(W.orderBy(F.desc(key), "rid", "did"))).filter(F.col("place") <= left).select("rid", "did", F.lit(True).alias("in"))
        return scored.join(ranked, ["rid", "did"], "left").withColumn("kept", (F.col(key) > high) | F.coalesce("in", F.lit(False))).drop("in")
    if edge.count() <= left:
        return scored.withColumn("kept", F.col(key) >= low)
    return top_k(scored.withColumn("_tie", F.when(F.col(key) == low, F.xxhash64("rid", "did").cast("double")).when(F.col(key) > low, F.lit(1e300)).otherwise(F.lit(-1e300))), k, "_tie").drop("_tie")


def resample(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """rid, did, doc_id, n_ngrams, log_weight, key, kept of every row.

    log_weight is the log of the text's importance weight: the sum over its n_ngrams features of log(target / raw),
    shrunk by evidence. The sample has k documents, as many as weigh at least the cut that parts the labelled ones
    best, and is drawn without replacement and in proportion to the weights: by the largest key, which is log_weight
    and standard Gumbel noise from a hash of doc_id, so reruns agree. Texts that are null, empty or blank are never
    drawn. Without labels of both kinds every other text is. Repeated rows are drawn alike, but for a tie at the
    end; a doc_id with several labels counts as its worst; unlabelled documents take part.
    """
    spark = docs.sparkSession
    ship(spark)
    models = fit_models(docs, labels)
    table = spark.sparkContext.broadcast(models.ratio)
    rows = with_row_key(docs, "doc_id", "text").select("rid", "did", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = rows.mapInArrow(_weigh(table, len(models.ratio)), "rid long, did long, doc_id long, n_ngrams long, log_weight double")
    uniform = (F.pmod(F.xxhash64("did", "n_ngrams", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    scored = staged(scored.withColumn("key", F.when(F.col("n_ngrams") > 0, F.col("log_weight") - F.log(-F.log(uniform)))), "weights")
    k = scored.filter((F.col("n_ngrams") > 0) & (F.col("log_weight") >= models.cut)).count()
    return top_k(scored, k).withColumn("kept", F.coalesce("kept", F.lit(False)))


def resample_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return resample(docs, labels).select("doc_id", "n_ngrams", "log_weight", "kept")


def drawn_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that the sample leaves out."""
    docs = as_scan(docs)
    return keep_rows(docs, resample(docs, labels).filter("kept"))
