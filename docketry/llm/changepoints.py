"""Penalised change points of daily series by segment-neighbourhood dynamic programming.

For each number of segments and each end day the exact best cost is kept; then the penalties are added, the least sum with the fewest segments is
chosen, and its starts are traced back, the earliest first. Series are summed by key and day before they are gathered by key, so what one
task gets of a key is a row for each of its days, never its rows. Many series go through the recursion at once, as array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FAR = np.int64(2**60)


def daily_series(rows: DataFrame, key: Column, day: Column, value: Column) -> DataFrame:
    """``key, days, sums``: for each key its days with rows (longs, ascending) and their sums. A null key is a key of its own."""
    sums = rows.select(key.alias("key"), day.cast("long").alias("day"), value.cast("long").alias("value")).where("day is not null and value is not null").groupBy("key", "day").agg(F.sum("value").alias("total"))
    packed = sums.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("day", "total"))).alias("s"))  # at most one entry for each day
    return packed.select("key", F.col("s.day").alias("days"), F.col("s.total").alias("sums"))


def _spreads(n: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return 1 + (n * squares - sums * sums) // (n * n)


def _costs(n: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    return n * np.floor(1000 * np.log(spreads.astype(float))).astype(np.int64)


def segment(series: list[np.ndarray], least: int = 5, penalty: int = 10_000) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each series (whole numbers) the starts of its segments, their sums, spreads and costs, and the best cost with penalties.

    A segment's cost is ``n * floor(1000 ln V)`` with ``V = 1 + floor((n Q - S S) / n^2)``; costs are never below 0, so more segments than the cost of the
    undivided series pays for cannot be best and are not tried. Whole numbers are exact at any size: Python's, where 64 bits might not do.
    """
    width = max(map(len, series))
    top = max(int(np.abs(s.astype(object)).max(initial=0)) for s in series)
    exact = np.int64 if (width * max(top, 1)) ** 2 < 2**62 else object
    values = np.zeros((len(series), width), exact)
    for k, s in enumerate(series):
        values[k, : len(s)] = s
    sums, squares = (np.concatenate([np.zeros((len(series), 1), exact), np.cumsum(x, axis=1)], axis=1) for x in (values, values * values))
    lengths = np.array([len(s) for s in series])
    every = np.arange(len(series))
    whole = _costs(lengths, _spreads(lengths.astype(exact), sums[every, lengths], squares[every, lengths]))
    most = int(max(1, (np.minimum(lengths // least, 1 + whole // penalty) if penalty > 0 else lengths // least).max()))
    best = np.full((len(series), most, width + 1), _FAR)  # of so many segments (less one) that end before the day
    start = np.zeros((len(series), most, width + 1), np.int32)
    for end in range(least, width + 1):
        n = end - np.arange(end - least + 1)
        costs = _costs(n[None, :], _spreads(n[None, :].astype(exact), sums[:, end : end + 1] - sums[:, : len(n)], squares[:, end : end + 1] - squares[:, : len(n)]))
        best[:, 0, end] = costs[:, 0]
        if most > 1:
            joined = best[:, :-1, : len(n)] + costs[:, None, :]
            at = joined.argmin(axis=2)  # the first, so the earliest start
            start[:, 1:, end] = at
            best[:, 1:, end] = np.minimum(np.take_along_axis(joined, at[:, :, None], axis=2)[:, :, 0], _FAR)
    out = []
    for k, n in enumerate(lengths):
        totals = best[k, :, n] + penalty * np.arange(most)
        totals[0] = whole[k]  # also where the series is too short to be cut
        count = int(totals.argmin())
        ends = [int(n)]
        for left in range(count, 0, -1):
            ends.insert(0, int(start[k, left, ends[0]]))
        starts, stops = np.array([0, *ends[:-1]]), np.array(ends)
        sizes, s = (stops - starts).astype(exact), sums[k, stops] - sums[k, starts]
        spreads = _spreads(sizes, s, squares[k, stops] - squares[k, starts])
        out.append((starts, s, spreads, _costs(stops - starts, spreads), int(totals[count])))
    return out


def change_points(series: DataFrame, key_type: str = "bigint", least: int = 5, penalty: int = 10_000, cells: int = 1 << 18) -> DataFrame:
    """``key, segment_no, first_day, n_days, total, spread, cost, n_segments, best_cost`` for each segment of ``series(key, days, sums)``.

    Series run from their first to their last day; days between without an entry are 0. A series of fewer than ``2 * least`` days is one segment. Memory
    grows with the days of a series times its possible segments; about ``cells`` of them are worked on at once.
    """
    names = ("segment_no", "first_day", "n_days", "total", "spread", "cost", "n_segments", "best_cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, days, sums = (batch.column(c) for c in ("key", "days", "sums"))
            spans = [(int(d[-1].as_py()) - int(d[0].as_py()) + 1) for d in days]
            order, at = np.argsort(spans, kind="stable"), 0
            while at < len(order):
                size = 1
                while at + size < len(order) and (size + 1) * spans[order[at + size]] ** 2 // least <= cells:
                    size += 1
                chosen, series = order[at : at + size], []
                for k in chosen:
                    day, total = np.array(days[int(k)].as_py(), np.int64), np.array(sums[int(k)].as_py(), object)
                    line = np.zeros(spans[k], object if any(abs(x) >= 2**62 for x in total) else np.int64)
                    line[day - day[0]] = total
                    series.append(line)
                columns: list[list] = [[] for _ in names]
                at += size
                index = []
                for k, (starts, s, spreads, costs, total) in zip(chosen, segment(series, least, penalty), strict=True):
                    n, first = len(starts), int(days[int(k)][0].as_py())
                    sizes = np.diff([*starts, spans[k]])
                    index += [int(k)] * n
                    for column, part in zip(columns, (range(1, n + 1), starts + first, sizes, s, spreads, costs, [n] * n, [total] * n), strict=True):
                        column += map(int, part)
                types = [pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(index, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["key", *names])

    schema = f"key {key_type}, segment_no int, " + ", ".join(f"{n} long" for n in names[1:])
    return series.mapInArrow(run, schema)


def vendor_change_points(lines: DataFrame, flags: tuple[str, ...] = ("kept", "swapped"), least: int = 5, penalty: int = 10_000) -> DataFrame:
    """Segments of each vendor's daily quantities in ``lines(vendor_id, quantity, flag, shipped_at, ...)``.

    Rows of other flags (or none), without a quantity or a day of shipping take no part; repeated rows count each time; rows without a vendor are
    one series of their own. No rows give no segments. Other columns are ignored.
    """
    taken = lines.where(F.col("flag").isin(*flags))
    kind = dict(lines.dtypes)["vendor_id"]
    found = change_points(daily_series(taken, F.col("vendor_id"), F.unix_date(F.to_date("shipped_at")), F.col("quantity")), kind, least, penalty)
    return found.withColumnRenamed("key", "vendor_id")
