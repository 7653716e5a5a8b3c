"""Assembly of sales from their header and lines as they arrive, by a stateful streaming query that is restarted per batch.

applyInPandasWithState keeps the open assemblies: a state for each state key, which stands for a bounded number of sale ids,
with a packed record for each, and an event-time timeout that closes what waits too long. As a micro-batch handles its
rows before its timeouts, and its watermark is the largest day of the batches before, closures follow the data. Rows are
combined by sale and day in every Arrow batch before they are shuffled, so a sale with many lines is no hot key.

States are in the executors' heaps and in the checkpoint, some 15 bytes for an open assembly. RocksDB isn't used, as
Spark 4.1 leaves half a MB of native memory behind for each store that a start opens.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from litloom.llm.runtime import path_exists, run_dir, ship

#: 2024-01-01, and the days that the batches share out; days count from 1970-01-01.
FIRST_DAY, DAYS = 19723, 160
BATCHES, WAIT = 12, 20
#: Input rows for each state key, some 3,000 sales.
ROWS_PER_KEY = 16384
#: Events that are combined before they are shuffled.
PACK = 65536
#: Days from the year 0 to 1970: with them, no event time is before Spark's first watermark, which is 0.
SHIFT = 719_528
#: A day's length in event time: a second, so that all days are times that pandas can hold.
DAY_MS = 1000
#: The sentinel's day, after any that Spark can date.
LAST_DAY = 3_000_000
NO_DUE = -(2**63)
#: Of states' records.
CODEC = "zstd"

EVENT = "sale_id long, day long, n_lines long, cents long, n_sales long, due long"
STATE = "n long, assemblies binary"
PACKED = "state_key long, last_day long, events binary"
CLOSING = "sale_id long, first_day long, last_day long, n_lines long, cents long, due long, status string, closing_batch int"
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",  # a stopped start's states leave the heap soon
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",  # a file less for each store and batch
}
#: Whether a start runs a batch without data after its own, if its data have moved the watermark.
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _cents(amount: str) -> Column:
    """Whole cents; 0 for null, NaN and infinite amounts."""
    finite = F.col(amount).isNotNull() & ~F.isnan(amount) & (F.abs(F.col(amount).cast("double")) != float("inf"))
    return F.when(finite, F.floor(F.col(amount).cast("double") * 100 + 0.5)).otherwise(F.lit(0)).cast("long")


def _day(at: str) -> Column:
    return F.unix_date(F.col(at).cast("date")).cast("long")


def _crc(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def _batch(day: Column, n_batches: int, days: int) -> Column:
    return F.least(F.greatest(F.floor((day - FIRST_DAY) * n_batches / days), F.lit(0)), F.lit(n_batches - 1)).cast("int")


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """rows, with their batch, shuffled so that a batch lies in some tasks and not in all, whose files are few."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in by)), 1 + 2 * tasks // BATCHES)
    return rows.withColumn("_some", some).repartition("_batch", "_some")


def line_events(lines: DataFrame, n_batches: int = BATCHES, days: int = DAYS) -> DataFrame:
    """EVENT rows, and their batch, of distinct lines with a sale_id. A null line_no reads as no digits.

    Equal lines are of one batch and task, so the shuffle by batch is the one that finds them too.
    """
    h = _crc(F.concat(F.col("sale_id").cast("string"), F.lit(":"), F.coalesce(F.col("line_no").cast("string"), F.lit(""))))
    day = F.coalesce(_day("shipped_at") + h % 4, FIRST_DAY + h % 152)
    own = lines.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(lines.columns)), F.col("sale_id").cast("long").alias("sale"), day.alias("on"), _cents("amount").alias("paid")).filter("sale is not null")
    distinct = _dealt(own.withColumn("_batch", _batch(F.col("on"), n_batches, days)), *own.columns).distinct()
    zero = F.lit(0).cast("long")
    return distinct.select(F.col("sale").alias("sale_id"), F.col("on").alias("day"), F.lit(1).cast("long").alias("n_lines"), F.col("paid").alias("cents"), zero.alias("n_sales"), F.lit(NO_DUE).cast("long").alias("due"), F.col("_batch").alias("batch"))


def sale_events(sales: DataFrame, line_events: DataFrame) -> DataFrame:
    """EVENT rows of sales, with what is due for each; without an arrival they come on FIRST_DAY.

    A sale's lines are summed by day first, so that one with many lines is spread before its sums meet.
    """
    by_day = line_events.groupBy("sale_id", "day").agg(F.sum("cents").alias("cents"))
    sums = by_day.groupBy("sale_id").agg(F.sum("cents").alias("all"), F.max_by("cents", "day").alias("last"))
    own = sales.filter(F.col("sale_id").isNotNull()).select(F.col("sale_id").cast("long").alias("sale_id"), F.coalesce(_day("arrived_at"), F.lit(FIRST_DAY).cast("long")).alias("day"), _cents("total").alias("total"))
    rule = _crc(F.col("sale_id").cast("string")) % 5
    due = F.when(rule == 0, F.col("total")).when(rule == 1, F.coalesce(F.col("all") - F.col("last"), F.lit(0))).otherwise(F.coalesce("all", F.lit(0)))
    none = F.lit(0).cast("long")
    return own.join(sums, "sale_id", "left").select("sale_id", "day", none.alias("n_lines"), none.alias("cents"), F.lit(1).cast("long").alias("n_sales"), due.alias("due"))


def write_batches(sales: DataFrame, lines: DataFrame, folder: str, n_batches: int = BATCHES, days: int = DAYS) -> None:
    """Events under folder/batch=0 to batch=n_batches-1 by arrival day, batches without events as a file without rows.

    The last one also holds the sentinel, an event after all days, whose watermark comes to be that of a batch without
    data, where every timer that is left fires.
    """
    spark = sales.sparkSession
    line_events(lines, n_batches, days).write.partitionBy("batch").parquet(folder)
    arrived = spark.read.schema(EVENT).parquet(folder)
    sold = sale_events(sales, arrived).withColumn("_batch", _batch(F.col("day"), n_batches, days))
    _dealt(sold, "sale_id").drop("_some").withColumnRenamed("_batch", "batch").write.mode("append").partitionBy("batch").parquet(folder)
    for k in range(n_batches):
        if not path_exists(spark, f"{folder}/batch={k}"):
            spark.createDataFrame([], EVENT).write.parquet(f"{folder}/batch={k}")
    spark.createDataFrame([(0, LAST_DAY, 0, 0, 0, NO_DUE)], EVENT).coalesce(1).write.mode("append").parquet(f"{folder}/batch={n_batches - 1}")


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events, with their state_key, as PACKED rows: one for each state key of some PACK events, in which those of one
    sale and day are one event. Of several dues the largest holds."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        names = ["state_key", "sale_id", "day"]
        sums = pa.Table.from_batches(held).group_by(names).aggregate([("n_lines", "sum"), ("cents", "sum"), ("n_sales", "sum"), ("due", "max")])
        cells = np.stack([sums[c].to_numpy() for c in [*names, "n_lines_sum", "cents_sum", "n_sales_sum", "due_max"]], 1).astype("<i8")
        cells = cells[np.argsort(cells[:, 0], kind="stable")]
        starts = np.flatnonzero(np.append(True, cells[1:, 0] != cells[:-1, 0]))
        parts = [x[:, 1:].tobytes() for x in np.split(cells, starts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(cells[starts, 0]), pa.array(np.maximum.reduceat(cells[:, 2], starts)), pa.array(parts, pa.binary())], ["state_key", "last_day", "events"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= PACK:
            yield out()
            held.clear()
    if held:
        yield out()


def _open(state: GroupState) -> dict[int, list[int]]:
    """A state's open assemblies by sale_id."""
    if not state.exists:
        return {}
    n, held = state.get
    cells = np.frombuffer(pa.decompress(held, 56 * n, CODEC, asbytes=True), "<i8").reshape(7, n)
    return {r[0]: r for r in cells.T.tolist()}


def assembler(batch: int, wait: int = WAIT) -> Callable:
    """Joins the events of the sales of a state key; batch is written into the closings of this start of the query.

    The state is a table of seven 64-bit numbers a row, column by column and compressed, a row for each open assembly: sale_id,
    first and last day, lines, cents, sales, due. It times out on the earliest day at which one of them is to close.
    """

    def due_at(first_day: int) -> int:
        """A millisecond before the day on which an assembly begun on first_day closes; watermarks are whole days."""
        return (first_day + wait + SHIFT) * DAY_MS - 1

    def closings(rows: list[list[int]], statuses: list[str]) -> pd.DataFrame:
        cells = np.array(rows, "<i8").reshape(-1, 7)
        due = pd.array(cells[:, 6], "Int64")
        due[cells[:, 5] == 0] = pd.NA
        return pd.DataFrame({"sale_id": cells[:, 0], "first_day": cells[:, 1], "last_day": cells[:, 2], "n_lines": cells[:, 3], "cents": cells[:, 4], "due": due, "status": statuses, "closing_batch": np.full(len(cells), batch, "int32")})

    def join(assemblies: dict[int, list[int]], events: np.ndarray) -> list[list[int]]:
        """The assemblies that events complete, which leave the open ones."""
        events, complete = events[np.lexsort((events[:, 1], events[:, 0]))], []
        ends = np.append((events[1:, :2] != events[:-1, :2]).any(1), True)  # of a sale's day
        for (sale, day, n_lines, cents, n_sales, due), end in zip(events.tolist(), ends.tolist(), strict=True):
            held = assemblies.get(sale)
            if held is None:
                held = assemblies[sale] = [sale, day, day, 0, 0, 0, NO_DUE]
            held[2] = day
            held[3] += n_lines
            held[4] += cents
            held[5] += n_sales
            held[6] = max(held[6], due)
            if end and held[5] and held[3] and held[4] == held[6]:
                complete.append(assemblies.pop(sale))
        return complete

    def assemble(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        assemblies = _open(state)
        parts = [np.frombuffer(x, "<i8").reshape(-1, 6) for part in rows for x in part["events"]]
        events = np.concatenate([np.zeros((0, 6), "<i8"), *parts])
        events = events[events[:, 1] < LAST_DAY]  # without the sentinel
        complete = join(assemblies, events) if len(events) else []
        seen = state.getCurrentWatermarkMs()
        late = [r for r in assemblies.values() if due_at(r[1]) < seen]
        for row in late:
            del assemblies[row[0]]
        if assemblies:
            cells = np.array(list(assemblies.values()), "<i8")
            state.update((len(cells), pa.compress(cells.T.tobytes(), CODEC, asbytes=True)))
            state.setTimeoutTimestamp(due_at(int(cells[:, 1].min())))
        elif state.exists:
            state.remove()
        statuses = ["complete"] * len(complete) + ["headless" if not r[5] else "orphan" if not r[3] else "short" if r[4] < r[6] else "over" for r in late]
        if statuses:
            yield closings(complete + late, statuses)

    return assemble


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def assembled_sales(sales: DataFrame, lines: DataFrame, n_batches: int = BATCHES, wait: int = WAIT, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """A row (CLOSING) for each assembly of a sale's events, as it closes.

    The events are written in n_batches by day, and fed in order to one query, which is started again for each of them
    on one checkpoint; a start that fails may be repeated, as sources, state and results are all committed by batch.
    The last start goes on to a batch without data after the sentinel that it ends with, which closes what is left. Every
    start opens every state store, so there are no more starts than batches, and no more stores than keys. Rows with null sale_ids are left out. Of equal lines one counts; of sales of one id each
    counts, and in one assembly the largest due holds. Null amounts, and such as aren't finite, are 0 cents. No events,
    no closings. Columns that aren't used only count for which lines are equal.
    """
    spark = sales.sparkSession
    ship(spark)
    folder = f"{run_dir(spark)}/assembly-{uuid.uuid4().hex}"
    write_batches(sales, lines, f"{folder}/feed", n_batches)
    n_keys = 1 + spark.read.schema(EVENT).parquet(f"{folder}/feed").count() // rows_per_key
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_keys)
    with _settings(spark, STREAMING | {"spark.sql.shuffle.partitions": str(stores), NO_DATA: "false"}):
        for k in range(n_batches):
            spark.conf.set(NO_DATA, str(k == n_batches - 1).lower())
            # A start lists the batches before too, which the checkpoint knows as read.
            fed = ",".join(map(str, range(k + 1)))
            events = spark.readStream.schema(EVENT).parquet(f"{folder}/feed/batch={{{fed}}}")
            keyed = events.withColumn("state_key", F.pmod(F.xxhash64("sale_id"), F.lit(n_keys))).mapInArrow(packed, PACKED)
            keyed = keyed.withColumn("at", F.timestamp_millis((F.col("last_day") + SHIFT) * DAY_MS))
            closings = keyed.withWatermark("at", "0 seconds").groupBy("state_key").applyInPandasWithState(assembler(k, wait), CLOSING, STATE, "append", GroupStateTimeout.EventTimeTimeout)
            query = closings.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{folder}/closings")
            query.awaitTermination()
    return spark.read.schema(CLOSING).parquet(f"{folder}/closings")
