"""Mixing sources to target weights, by blocks of words; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litloom.llm.runtime import WORD, all_columns, as_scan, staged, with_row_key

#: Words in a block, at most. Larger blocks make fewer rows.
BLOCK_WORDS = 256
#: Each source lies in so many lanes, whose lengths are added up before any row's offset.
LANES = 1024
#: Slots that one row is expanded into at a time.
CHUNK = 65536
#: Multipliers of the permutations; primes above 2^30, so one that divides a count is rare and the other serves.
PRIMES = (1610612741, 1073741827)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: int = 3) -> DataFrame:
    """source, sid, source_size, target: the share by weight of all sizes, none above cap times its source's.

    Sources weigh 1, 2, 3, repeating, in code point order, null last. Raising a common level until the
    targets min(cap * size, level * weight) meet the total equals resharing the excess until none is above:
    sources are taken in the order of cap * size / weight, and those below the level are full.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # A row for each source, not for each document.
    ranked = sources.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumns({"weight": (F.col("sid") % 3 + 1).cast("double"), "most": (F.col("source_size") * cap).cast("double")})
    order = W.orderBy(F.col("most") / F.col("weight"), "sid")
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = weighed.withColumns(
        {
            "level": (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        }
    )
    open_ = F.col("most") / F.col("weight") >= F.col("level")
    level = F.min(F.when(open_, F.struct(F.col("most") / F.col("weight"), "sid", "level"))).over(whole)["level"]
    return levels.withColumn("final", level).select("source", "sid", "source_size", F.least(F.col("most"), F.coalesce(F.col("final") * F.col("weight"), F.col("most"))).alias("target"))


def lay_out(sizes: DataFrame) -> DataFrame:
    """The rows with their offset in the words of their source, by prefix sums over lanes and within them."""
    laned = sizes.withColumn("lane", F.pmod(F.xxhash64("did", "size"), F.lit(LANES)))
    lanes = laned.groupBy("sid", "lane").agg(F.sum("size").alias("words"))
    bases = lanes.select("sid", "lane", F.coalesce(F.sum("words").over(W.partitionBy("sid").orderBy("lane").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    upto = F.sum("size").over(W.partitionBy("sid", "lane").orderBy("did", "size", "rid").rowsBetween(W.unboundedPreceding, 0))
    return laned.withColumn("upto", upto).join(bases, ["sid", "lane"]).withColumn("offset", F.col("base") + F.col("upto") - F.col("size")).drop("lane", "upto", "base")


def blocks_of(targets: DataFrame, block_words: int) -> DataFrame:
    """sid, n, length, longer, whole, rest: a source's words in n blocks of `length` words, the first `longer` of them
    one word longer; and its target in whole slots, of one block each, and the rest of a last one, in words."""
    n = F.ceil(F.col("source_size") / block_words)
    sized = targets.filter("source_size > 0").withColumn("n", n).withColumn("whole", F.least(F.floor(F.col("target") * F.col("n") / F.col("source_size")), 3 * F.col("n")))
    rest = F.round(F.col("target") - F.col("whole") * F.col("source_size") / F.col("n")).cast("long")
    return sized.select("sid", "n", F.expr("source_size div n").alias("length"), F.expr("source_size % n").alias("longer"), "whole", F.when(F.col("whole") < 3 * F.col("n"), rest).otherwise(F.lit(0)).alias("rest"))


def draw_slots(blocks: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """shard, sid, pass, j, block, most: each of a source's slots falls to an output shard by its own draw.

    So a source's counts over the shards are a multinomial draw, given that their sum is its target. Slot j is
    mapped by an affine permutation of the source's block indices, another one for each pass over them. A slot
    takes the first `most` words of its block, null for all.
    """
    chunks = blocks.withColumn("slots", F.col("whole") + (F.col("rest") > 0).cast("long")).filter("slots > 0").withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})"))).repartition("sid", "chunk")
    slots = chunks.withColumn("j", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(chunk * {CHUNK} + {CHUNK - 1}, slots - 1))"))).withColumn("pass", F.expr("j div n"))
    factor = F.when(F.lit(PRIMES[0]) % F.col("n") != 0, F.lit(PRIMES[0])).otherwise(F.lit(PRIMES[1])).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(seed), "sid", "pass"), F.col("n"))
    turned = F.pmod((F.col("j") % F.col("n")) * (factor % F.col("n")) + shift, F.col("n"))
    # A second round with the order reversed in between; each step is one to one on 0 .. n - 1.
    block = F.pmod((F.col("n") - 1 - turned) * (factor % F.col("n")) + F.pmod(F.xxhash64(F.lit(seed + 1), "sid", "pass"), F.col("n")), F.col("n"))
    most = F.when(F.col("j") == F.col("whole"), F.col("rest")).alias("most")
    return slots.select(F.pmod(F.xxhash64(F.lit(seed + 2), "sid", "j"), F.lit(n_shards)).cast("int").alias("shard"), "sid", "pass", "j", block.alias("block"), most)


def mix_plan(docs: DataFrame, n_shards: int = 64, block_words: int = BLOCK_WORDS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(rows, takes): every row with size, source_size and target; and for each piece of a row that a slot takes,
    the pass and the shard of the slot, where the piece starts in the row, and its words.

    Within a source rows lie in the order of (lane, doc_id, size), so reruns agree. A null source is a source of its
    own, the last; null, empty and blank texts have size 0 and are never taken. Repeated rows are rows of
    their own. No block is taken more than three times, so no row is. A source takes its target but for a word or
    so in each block of its last pass, as blocks differ by one word. An empty table gives no rows.
    """
    found = with_row_key(docs, "doc_id", "source", "text").select("rid", "did", "doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = staged(found, "sizes")
    targets = staged(source_targets(sizes), "targets")
    rows = sizes.join(targets, sizes.source.eqNullSafe(targets.source)).drop(targets.source)
    blocks = blocks_of(targets, block_words)
    laid = lay_out(rows.select("rid", "did", "sid", "size")).filter("size > 0").join(blocks.select("sid", "length", "longer"), "sid")
    holds = lambda at: f"if({at} < longer * (length + 1), {at} div (length + 1), longer + ({at} - longer * (length + 1)) div length)"
    pieces = (
        laid.withColumn("block", F.explode(F.expr(f"sequence({holds('offset')}, {holds('(offset + size - 1)')})")))
        .withColumn("begin", F.expr("block * length + least(block, longer)"))
        .withColumn("end", F.expr("begin + length + if(block < longer, 1, 0)"))
    )
    # The slots come from a few rows of targets, by which the planner would take them for few and broadcast them.
    slots = draw_slots(blocks, n_shards, seed).hint("merge")
    upto = F.least("end", F.col("begin") + F.coalesce("most", F.lit(1 << 40)), F.col("offset") + F.col("size"))
    taken = pieces.join(slots, ["sid", "block"]).withColumn("start", F.greatest("begin", "offset")).withColumn("words", upto - F.col("start")).filter("words > 0")
    return rows, taken.select("rid", "did", "pass", "shard", (F.col("start") - F.col("offset")).alias("start"), "words")


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    rows, takes = mix_plan(docs)
    taken = takes.groupBy("rid", "did").agg(F.sum("words").alias("taken"))
    return rows.join(taken, ["rid", "did"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, n_shards: int = 64, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """The mix as documents: for each pass over a row, one row with the words that it takes, joined by spaces.

    A row that no slot took is gone; one that several passes took comes up to three times with its doc_id.
    Columns are those of docs; n_chars, where there is one, is that of the new text.
    """
    docs = as_scan(docs)
    _, takes = mix_plan(docs, n_shards, block_words, seed)
    passes = takes.groupBy("rid", "did", "pass").agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("cuts"))
    rows, names = all_columns(docs)
    words = F.regexp_extract_all(names["text"], F.lit(WORD), F.lit(0))
    # The one-element array holds the words, so that they are found once and not for each cut.
    cut = F.transform(F.array(words), lambda w: F.flatten(F.transform("cuts", lambda c: F.slice(w, c["start"] + 1, c["words"]))))[0]
    new = {"text": F.array_join(cut, " ")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(new["text"]).cast("long")
    return rows.join(passes, ["rid", "did"]).select(*(new.get(c, F.col(n)).alias(c) for c, n in names.items()))
