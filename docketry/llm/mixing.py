"""Mixing sources to target weights by weighted fair queueing.

Every source serves its shuffled documents, and then their copies, one after the other. A copy's virtual finish
time is the words its source has served up to its end, divided by the source's target. All sources run at one
clock, so the copies sorted by finish time are the mix, and at time 1 each source has served its target and all
together the budget: there the mix is cut. A copy in service at the cut gives the words it has served by then.

A source may hold a third of all rows, so no window runs over a source. Documents are dealt to blocks by their
shuffle key; sums by (source, block) give each block its start, and running sums go over one block of one source.
The number of blocks grows with the square root of the rows, as the rows of a block do, so neither windows over blocks nor those within one
outgrow a task. The same holds for the global order: sums by stretch of virtual time tell in which one the budget ends, and only that one is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.durable import checkpointed

#: A word for sizes: anything between ASCII blanks and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``sizes(source, source_size)``, one row for each source.

    Sources by code point, null last, take the weights in turn and share ``share`` times all sizes. No target is
    above ``repeats`` times its source's size; what is cut off is shared by weight among the others until none
    is above. That is one water level: target = min(level * weight, cap). Going through the sources by cap per
    weight, with those before at their caps, the level falls from the first source that it does not drown, so
    it is the greatest level that lies within its own source's cap. These windows see one row for each source.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap, after = Window.orderBy("cap_per_weight", "turn"), Window.orderBy("cap_per_weight", "turn").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("turn", F.row_number().over(turn) - 1).withColumn("weight", w)
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(repeats))).withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("capped_before", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("weight_from", F.sum("weight").over(after)).withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    rows = rows.withColumn("level", (F.col("budget") - F.col("capped_before")) / F.col("weight_from"))
    rows = rows.withColumn("level", F.max(F.when(F.col("level") <= F.col("cap_per_weight"), F.col("level"))).over(everything))
    return rows.select("source", "source_size", F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def schedule(docs: DataFrame, size: Column, keep: tuple[str, ...] = ("doc_id",), block_rows: int = 1024, **options) -> DataFrame:
    """``keep..., _source, size, source_size, target, begins`` for each row of ``docs(doc_id, source, ...)``. Blocks have ``block_rows`` rows or more.

    ``begins`` is the words of its source before the document in the first round; copy c begins ``c *
    source_size`` later, and its virtual finish time is ``(begins + c * source_size + size) / target``. The shuffle order is
    the MD5 of the doc_id, ties by id, size and a hash of the kept columns, so reruns agree. A null source is a source of
    its own and comes last.
    """
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null"))  # never null, so that window and join agree on the partitioning
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], source.alias("_source"), F.col("doc_id").alias("_id"), size.alias("_size"))
    rows = rows.withColumn("_key", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")))
    n = max(1, docs.count())
    bits = max(0, math.ceil(math.log2(n / max(block_rows, math.isqrt(n)))))
    rows = rows.withColumn("_block", F.shiftright(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long"), 32 - bits))
    sums = rows.groupBy("_source", "_block").agg(F.sum("_size").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sums.groupBy("_source").agg(F.sum("_sum").alias("source_size"))
    sizes = sizes.select(F.when(F.col("_source") != "null", F.substr("_source", F.lit(2))).alias("source"), "source_size")
    aims = targets(sizes, **options).withColumn("_aim_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    starts = sums.select("_source", "_block", before.alias("_before"))
    starts = starts.join(aims, F.col("_source") == F.col("_aim_source")).select(
        F.col("_source").alias("_s"), F.col("_block").alias("_b"), "_before", "source_size", "target"
    )
    rows = rows.withColumn("_tie", F.xxhash64(*[f"_k{i}" for i in range(len(keep))]))
    order = Window.partitionBy("_source", "_block").orderBy("_key", "_id", "_size", "_tie")
    within = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_within", within)
    rows = rows.join(starts, (F.col("_source") == F.col("_s")) & (F.col("_block") == F.col("_b")))
    return rows.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "_source", F.col("_size").alias("size"), "source_size", "target", (F.col("_before") + F.col("_within")).alias("begins")
    )


def served(copy: Column) -> Column:
    """Words that a copy (0, 1, ...) of a scheduled row gives to the mix: what it has served at virtual time 1."""
    begins = F.col("begins") + copy * F.col("source_size")
    return F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target") + F.lit(1e-6)) - begins)).cast("long")


def quanta(repeats: int) -> Column:
    """The pieces of a scheduled row that enter the queue, as an array of structs (finish, source, begins, words) in this order of service.

    Each copy is one piece, or two if its source's whole words of the target end within it, as a packet is cut where service may stop. A
    piece's virtual finish time is the words its source has served up to its end, divided by the source's target.
    """
    stop = F.floor(F.col("target") + F.lit(1e-6))
    pieces = []
    for copy in range(repeats):
        begins = F.col("begins") + F.lit(copy) * F.col("source_size")
        first = F.greatest(F.lit(0), F.least(F.col("size"), stop - begins)).cast("long")
        for at, n in ((begins, first), (begins + first, F.col("size") - first)):
            pieces.append(F.struct(F.try_divide(at + n, F.col("target")).alias("finish"), F.col("_source").alias("source"), at.cast("long").alias("begins"), n.cast("long").alias("words")))
    return F.filter(F.array(*pieces), lambda p: p["words"] > 0)


def cut(rows: DataFrame, repeats: int, stretches: int = 1024) -> DataFrame:
    """One row with a struct (at, left): the piece of the global order within or before which the budget ends, and the words it still gives; null if all fits.

    Pieces are range-partitioned by finish time; the sums of the stretches, added up, tell the one in which the budget (the whole words of
    all targets) is passed, and the running sum over that stretch, sorted, the piece.
    """
    parts = max(stretches, math.isqrt(rows.count()))
    pieces = rows.select(F.explode(quanta(repeats)).alias("p"))
    pieces = pieces.withColumn("stretch", F.least(F.floor(F.col("p.finish") * parts), F.lit(2 * parts)))
    budget = rows.groupBy("_source").agg(F.floor(F.max("target") + F.lit(1e-6)).alias("t")).agg(F.coalesce(F.sum("t"), F.lit(0))).scalar()
    sums = pieces.groupBy("stretch").agg(F.sum("p.words").alias("n"))
    upto = F.sum("n").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0))  # a row for each stretch
    passed = sums.withColumn("upto", upto).withColumn("budget", budget).where("upto > budget")
    passed = checkpointed(passed.agg(F.min(F.struct("stretch", (F.col("budget") - F.col("upto") + F.col("n")).alias("room"))).alias("m")).select("m.stretch", "m.room"))
    inside = pieces.where(F.col("stretch") == passed.select("stretch").scalar())
    before = F.coalesce(F.sum("p.words").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = inside.withColumn("left", passed.select("room").scalar() - before).where(F.col("p.words") > F.col("left"))
    return checkpointed(over.agg(F.min(F.struct(F.col("p").alias("at"), "left")).alias("cut")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2, block_rows: int = 1024) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs(doc_id, source, text)``.

    ``taken`` adds up the pieces of the row's copies that lie before the cut of the global order of finish times. Null and empty
    texts have size 0 and give nothing. Repeated rows are documents of their own. An empty table gives no rows. Other columns are ignored.
    """
    narrow = checkpointed(docs.select("doc_id", "source", words(F.col("text")).alias("_words")))  # the only look at the texts
    rows = checkpointed(schedule(narrow, F.col("_words"), block_rows=block_rows, weights=weights, share=share, repeats=repeats))
    found = rows.withColumn("cut", cut(rows, repeats).scalar())
    given = F.transform(quanta(repeats), lambda p: F.when(F.col("cut").isNull() | (p < F.col("cut.at")), p["words"]).when(p == F.col("cut.at"), F.col("cut.left")).otherwise(F.lit(0).cast("long")))
    return found.select("doc_id", "size", "source_size", "target", F.aggregate(given, F.lit(0).cast("long"), lambda a, b: a + b).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2, block_rows: int = 1024) -> DataFrame:
    """The mix itself, range-sorted by virtual finish time: one row for each copy that gives words.

    All sources run at one clock, so any stretch of time holds its share of the budget: equal stretches are the ranges, and
    no sample of the rows is needed to find them.

    Columns are those of ``docs``. The copy that is in service at the cut keeps its first words only, with
    ``n_chars`` (if there is such a column) set to the cut text's length. Null and empty texts give no words and so no rows; repeated rows are
    documents of their own; an empty table gives no rows.
    """
    names = docs.columns
    rows = schedule(docs, words(F.col("text")), tuple(names), block_rows, weights=weights, share=share, repeats=repeats).drop("_source")
    return _copies(rows, names, repeats)


def _copies(rows: DataFrame, names: list[str], repeats: int) -> DataFrame:
    inner = [f"_c{i}" for i in range(len(names))]
    rows = rows.toDF(*inner, "size", "source_size", "target", "begins")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("copy"))
    rows = rows.withColumn("words", served(F.col("copy"))).where("words > 0")
    finish = (F.col("begins") + F.col("copy") * F.col("source_size") + F.col("words")) / F.col("target")
    text = F.col(inner[names.index("text")])
    cut = _first_words(text, F.col("words"))
    whole = F.col("words") == F.col("size")
    out = {n: F.col(c) for n, c in zip(names, inner, strict=True)}
    out["text"] = F.when(whole, text).otherwise(cut)
    if "n_chars" in out:
        out["n_chars"] = F.when(whole, out["n_chars"]).otherwise(F.length(cut).cast("long"))
    tie = F.coalesce(F.col(inner[names.index("doc_id")]).cast("string"), F.lit(""))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.least(F.floor(finish * parts), F.lit(parts - 1)).cast("int")  # finish times are spread evenly over 0 to 1
    rows = rows.withColumn("_finish", finish).withColumn("_tie", tie).repartitionById(parts, place)
    return rows.sortWithinPartitions("_finish", "_tie", "copy").select(*[out[n].alias(n) for n in names])


def _first_words(text: Column, n: Column) -> Column:
    """The first n words, with single blanks between them."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), n.cast("int")), " ")
