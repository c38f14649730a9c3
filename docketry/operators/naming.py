"""Unique public file names, given greedily in path order and compared without case."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.durable import checkpointed, numbered, written

#: How names end that are given to the second and later rows of a stem.
NUMBER = r"_[1-9][0-9]*$"


def allocate(wanted: Iterable[tuple[str, str]], taken: set[str] | None = None) -> Iterator[str]:
    """A name for each (stem, extension) in turn: the name itself, or with ``_1``, ``_2``, ... the first that is free.

    The next number of a stem only grows, so a stem that comes up n times costs n steps, not n squared.
    """
    taken = set() if taken is None else taken
    next_number: dict[tuple[str, str], int] = {}
    for stem, ext in wanted:
        key = (stem.lower(), ext.lower())
        number = next_number.get(key, 0)
        while True:
            name = f"{stem}_{number}{ext}" if number else f"{stem}{ext}"
            number += 1
            if name.lower() not in taken:
                break
        next_number[key] = number
        taken.add(name.lower())
        yield name


def _links(stems: DataFrame) -> DataFrame:
    """``_name, _child, _k, _order, _key`` of the stems that are another one's name with a number: the parent, the child, the number, and the child's first row."""
    number = F.regexp_extract("_low", r"_([1-9][0-9]{0,17})$", 1)
    children = stems.where(number != "").select(_joined(F.regexp_replace("_low", NUMBER, ""), F.col("_lowext")).alias("_name"), _joined(F.col("_low"), F.col("_lowext")).alias("_child"), number.cast("long").alias("_k"), "_first.*")
    return children.join(stems.select(_joined(F.col("_low"), F.col("_lowext")).alias("_name")), "_name", "left_semi")


def _joined(low: Column, ext: Column) -> Column:
    return F.concat(low, F.lit("\x00"), ext)


def _skips(links: pd.DataFrame) -> pd.DataFrame:
    """Which numbers the rows of one stem skip, from the numbers ``_k`` that are stems themselves and ``_rows``, its rows before the first of each of these.

    A stem's rows take numbers in turn. At a number that is a stem, the row in turn takes it if it comes before that stem's first row, else it is taken
    already and is skipped.
    """
    links = links.sort_values("_k")
    skipped, turn, n = [], [], 0
    for k, before, base in zip(links["_k"], links["_rows"], links["_base"], strict=True):
        row = k - base - n
        skipped.append(row >= before)
        turn.append(row)
        n += row >= before
    return pd.DataFrame({"_name": links["_name"], "_child": links["_child"], "_skipped": skipped, "_turn": turn})


def _known(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``_name, _child, _skipped, _turn`` of each link: whether the parent's rows skip the number, and the row whose turn it was."""
    kept = ["_name", "_order", "_key"]
    markers = numbered(links.select(*kept, "_child", "_k"), "_name", ["_order", "_key"], "_nth").withColumn("_kind", F.lit(0))
    above = rows.join(links.select("_name").distinct(), "_name", "left_semi").select(*kept, F.lit(None).cast("string").alias("_child"), F.lit(None).cast("long").alias("_k"), F.lit(None).cast("int").alias("_nth"), F.lit(1).alias("_kind"))
    placed = numbered(markers.unionByName(above), "_name", ["_order", "_key", "_kind"], "_place").where("_kind = 0")
    placed, _ = written(placed.select("_name", "_child", "_k", (F.col("_place") - F.col("_nth")).cast("long").alias("_rows")))

    told = []
    now = placed.join(placed.select(F.col("_child").alias("_name")), "_name", "left_anti").withColumn("_base", F.lit(0).cast("long"))
    while True:
        level, _ = written(now.groupBy("_name").applyInPandas(_skips, "_name string, _child string, _skipped boolean, _turn long"))
        if level.isEmpty():
            break
        told.append(level)
        now = placed.join(level.select(F.col("_child").alias("_name"), F.when(F.col("_skipped"), 0).otherwise(1).cast("long").alias("_base")), "_name")
    return functools.reduce(DataFrame.unionByName, told, level)


def _turns(rows: DataFrame) -> DataFrame:
    """``_nth`` of each row within its stem, from 0."""
    return numbered(rows.drop("_low", "_lowext", "_n"), "_name", ["_order", "_key"], "_nth").withColumn("_nth", F.col("_nth").cast("long") - 1)


def _numbers(mine: DataFrame, events: DataFrame) -> DataFrame:
    """``_number`` of each row: its turn, and the numbers that were skipped up to it (``events(_name, _nth)``, each before the row of that turn)."""
    skipping = events.select("_name").distinct()
    plain = mine.join(skipping, "_name", "left_anti").withColumn("_number", F.col("_base") + F.col("_nth"))
    mixed = mine.join(skipping, "_name", "left_semi").withColumn("_kind", F.lit(1))
    events = events.join(mixed.select("_name").distinct(), "_name", "left_semi")  # others have no row that could come to them
    both = mixed.unionByName(events.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    mixed = numbered(both, "_name", ["_nth", "_kind"], "_place").where("_kind = 1").withColumn("_number", F.col("_base") + F.col("_place") - 1).drop("_kind", "_place")
    return plain.unionByName(mixed)


def unique_names(docs: DataFrame, key: str, order: str, stem: str = "stem", ext: str = "ext") -> DataFrame:
    """``key, filename`` for each row of ``docs``: what :func:`allocate` gives the rows in order, without going through them in order.

    A name can be wanted from two sides only: by the first row of the stem that it is, and by a row of the stem that it is with a number after it. For a
    row that has reached a number, the name is gone if the stem of that name has had a row before. So numbers of stems need the order of their own rows
    and of other stems' first rows, but not what those were given. Only whether a stem's first row still finds the bare name
    depends on the stem above, so that is told from the top down, in as many rounds as numbers follow one another at a name's end (``a_1_2``: two). All counting is by ranges, so a
    stem of any number of rows is spread over tasks; one task gets no more of a stem than its numbers that are stems themselves.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.col(stem).alias("_stem"), F.col(ext).alias("_ext"), F.lower(F.col(stem)).alias("_low"), F.lower(F.col(ext)).alias("_lowext"))
    rows = rows.withColumn("_name", _joined(F.col("_low"), F.col("_lowext")))
    stems = checkpointed(rows.groupBy("_low", "_lowext").agg(F.count("*").alias("_n"), F.min(F.struct("_order", "_key")).alias("_first")))
    links = checkpointed(_links(stems))
    many = stems.select(_joined(F.col("_low"), F.col("_lowext")).alias("_name"), "_n")
    rows = rows.join(many, "_name")
    if links.isEmpty():  # no number is a stem: rows are numbered as they come
        alone, mine = rows.where("_n = 1"), rows.where("_n > 1").withColumn("_base", F.lit(0))
        given = _turns(mine).withColumn("_number", F.col("_nth"))
    else:
        known = _known(rows.drop("_n"), links)
        bases = known.where("not _skipped").select(F.col("_child").alias("_name"), F.lit(1).alias("_base"))
        rows = rows.join(bases, "_name", "left").withColumn("_base", F.coalesce("_base", F.lit(0)))
        alone, mine = rows.where("_n = 1 and _base = 0"), _turns(rows.where("_n > 1 or _base = 1"))
        given = _numbers(mine, known.where("_skipped").select("_name", F.col("_turn").alias("_nth")))
    alone = alone.select(F.col("_key").alias("key"), F.concat("_stem", "_ext").alias("filename"))
    number = F.when(F.col("_number") > 0, F.concat(F.lit("_"), F.col("_number").cast("string"))).otherwise("")
    given = given.select(F.col("_key").alias("key"), F.concat("_stem", number, "_ext").alias("filename"))
    return alone.unionByName(given).select(F.col("key").alias(key), "filename")
