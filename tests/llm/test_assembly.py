"""Assembly of sales against a plain simulation in Python."""

import datetime as dt
import math
from collections import defaultdict
from unittest.mock import patch
from zlib import crc32

import pytest
from pyspark.sql.streaming import DataStreamWriter

from litloom.llm import assembly

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz"


def _crc(x):
    return crc32(str(x).encode())


def _cents(x):
    return 0 if x is None or not math.isfinite(x) else math.floor(100 * x + 0.5)


def _days(at):
    return (at.date() - dt.date(1970, 1, 1)).days


def plain(sales, lines, n=12):
    """sales: (sale_id, total, arrived_at); lines: whole rows, (sale_id, line_no, ..., amount, ..., shipped_at)."""
    events, per_sale = defaultdict(lambda: [0, 0, 0, None]), defaultdict(list)
    for row in set(lines):
        sale, line, amount, shipped = row[0], row[1], row[5], row[8]
        if sale is None:
            continue
        h = _crc(f"{sale}:{'' if line is None else line}")
        d = 19723 + h % 152 if shipped is None else _days(shipped) + h % 4
        e = events[d, sale]
        e[0], e[1] = e[0] + 1, e[1] + _cents(amount)
        per_sale[sale].append((d, _cents(amount)))
    for sale, total, arrived in sales:
        if sale is None:
            continue
        own, rule = per_sale.get(sale, []), _crc(sale) % 5
        last = max((d for d, _ in own), default=0)
        due = _cents(total) if rule == 0 else sum(c for d, c in own if rule != 1 or d < last)
        e = events[19723 if arrived is None else _days(arrived), sale]
        e[2], e[3] = e[2] + 1, due if e[3] is None else max(due, e[3])
    batch_of = lambda d: min(max((d - 19723) * n // 160, 0), n - 1)
    seen, out, held = None, [], {}
    for k in range(n):
        days = [key for key in sorted(events) if batch_of(key[0]) == k]
        for d, sale in days:
            lines_, cents, n_sales, due = events[d, sale]
            a = held.setdefault(sale, [d, d, 0, 0, None])
            a[1], a[2], a[3] = d, a[2] + lines_, a[3] + cents
            if n_sales:
                a[4] = due if a[4] is None else max(a[4], due)
            if a[4] is not None and a[2] and a[3] == a[4]:
                out.append((sale, *held.pop(sale), "complete", k))
        for sale, a in list(held.items()):
            if k == n - 1 or seen is not None and a[0] + 20 <= seen:
                del held[sale]
                out.append((sale, *a, "headless" if a[4] is None else "orphan" if not a[2] else "short" if a[3] < a[4] else "over", k))
        seen = max([d for d, _ in days] + ([] if seen is None else [seen]), default=None)
    return sorted(out, key=repr)


def _line(sale, no, amount, shipped, item=1):
    return (sale, no, item, 1, 1, amount, 0.0, "kept", shipped)


def _run(spark, sales, lines, **more):
    s = spark.createDataFrame([(i, 1, "done", t, None, at, 1) for i, t, at in sales], SALES)
    got = assembly.assembled_sales(s, spark.createDataFrame(lines, LINES), **more)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def _at(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=5)


def _odd():
    sales = [(None, 1.0, _at(0)), (1, None, None), (2, float("nan"), _at(3)), (3, 5.0, _at(1)), (3, 7.0, _at(1)), (3, 5.0, _at(90)), (4, 0.0, _at(50)), (5, 2.5, dt.datetime(1960, 1, 1)), (6, 2.5, dt.datetime(2090, 1, 1))]
    lines = [_line(None, 1, 2.0, _at(1)), _line(7, None, 2.0, None), _line(7, None, 2.0, None), _line(8, 1, None, _at(400)), _line(8, 2, float("inf"), _at(2)), _line(9, 1, 1.0, dt.datetime(1950, 5, 5)), _line(9, 2, 1.0, dt.datetime(1969, 5, 5))]
    for i in range(10, 120):
        k = i % 7
        sales += [(i, 1.25 * k, _at(i % 110))] * (k > 0)
        lines += [_line(i, j, 1.25, _at((i % 90) + 9 * j * (i % 3)), j % 2) for j in range(k)] * (1 + i % 2)
    sales += [(i, 0.5, _at(40)) for i in range(300, 320)]
    lines += [_line(i, j, 2.0, _at(20 + j)) for i in range(300, 320) for j in range(3)]  # some get more than is due
    lines += [_line(200, j % 5, 0.01 * j, _at(j % 60), j) for j in range(3000)]  # a hot sale
    return sales + [(200, 1.0, _at(20))], lines


@pytest.mark.parametrize(("rows_per_key", "n"), [(40, 12), (16384, 3)])
def test_equals_a_plain_simulation(spark, rows_per_key, n):
    sales, lines = _odd()
    got = _run(spark, sales, lines, rows_per_key=rows_per_key, n_batches=n)
    assert got == plain(sales, lines, n)
    assert n < 12 or {r[6] for r in got} == {"complete", "headless", "orphan", "short", "over"}


def test_empty_tables_and_batches(spark):
    assert _run(spark, [], [], n_batches=1) == []
    sales, lines = [(1, 1.0, _at(2)), (2, 1.0, _at(159))], [_line(1, 1, 1.0, _at(60))]
    assert _run(spark, sales, lines, n_batches=4) == plain(sales, lines, 4)


def test_starts_and_stores_are_as_few_as_batches_and_keys(spark):
    sales, lines = [(1, 1.0, _at(2)), (2, 1.0, _at(159))], [_line(1, 1, 1.0, _at(60))]
    s = spark.createDataFrame([(i, 1, "done", t, None, at, 1) for i, t, at in sales], SALES)
    runs = []
    start = DataStreamWriter.start
    with patch.object(DataStreamWriter, "start", lambda *a, **b: runs.append(start(*a, **b)) or runs[-1]):
        got = assembly.assembled_sales(s, spark.createDataFrame(lines, LINES), n_batches=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(sales, lines, 3)
    assert len(runs) == 3 and {o.numShufflePartitions for q in runs for p in q.recentProgress for o in p.stateOperators} == {1}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_states_are_not_in_native_memory(spark):
    """Spark doesn't free what a RocksDB store counts with, half a MB for each that any start opens."""
    runs = []
    start = DataStreamWriter.start
    sales, lines = _odd()
    with patch.object(DataStreamWriter, "start", lambda *a, **b: runs.append(start(*a, **b)) or runs[-1]):
        got = _run(spark, sales, lines, n_batches=2, rows_per_key=100)
    operators = [o for q in runs for p in q.recentProgress for o in p.stateOperators]
    assert got == plain(sales, lines, 2) and sum(o.numRowsUpdated for o in operators) > 0
    assert not [m for o in operators for m in o.customMetrics if m.startswith("rocksdb")]


def test_given_tables(spark, sf_dir):
    s, li = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("sales", "sale_lines"))
    got = assembly.assembled_sales(s.withColumn("day", s.total), li.withColumn("batch", li.line_no), n_batches=4)
    want = plain([(r.sale_id, r.total, r.arrived_at) for r in s.collect()], [tuple(r) for r in li.collect()], 4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
