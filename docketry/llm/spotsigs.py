"""Document fingerprints by spot signatures, in SQL functions only.

Wherever a common word (an anchor) stands, it and the next two words that are no anchors form a signature; a text's
fingerprint is the sorted set of its signatures' 32-bit hashes. Running text is full of anchors and lists, menus and
notices are not, so what two texts share outside of prose hardly counts (Theobald, Siddharth and Paepcke, "SpotSigs", 2008).
A text without any signature has one made of its whole word sequence, so that equal texts agree, as do texts of equal words; other such texts do not.

Sets are compared by Jaccard similarity, which cannot exceed the smaller size by the larger: pairs are looked for only
among sets of near lengths, and there only where the rarest signatures of a set meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Anchors: frequent words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from had has have he in is it of on or she that the they this to was were which with you "
    "als am an auf aus bei das dass dem den der des die ein eine einem einen einer er es hat ich im in ist mit nicht noch oder sich sie sind und von war werden wie wird zu zum zur "
    "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour que qui sa se ses son sont sur un une vous "
    "al como con de del el ella en es esta este la las lo los no nos para pero por que se son su sus un una y"
).split()

_MARK = "\x01"
_CHAIN = rf"(?=({_MARK}\S+ (?:{_MARK}\S+ )*+\S+ (?:{_MARK}\S+ )*+\S+) ){_MARK}"


def signature_set(text: Column) -> Column:
    """The sorted distinct signature hashes (array of long) of a text; null counts as empty."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    marked = F.transform(F.split(plain, " "), lambda w: F.when(w.isin(ANCHORS), F.concat(F.lit(_MARK), w)).otherwise(w))
    chains = F.regexp_extract_all(F.concat(F.array_join(marked, " "), F.lit(" ")), F.lit(_CHAIN), F.lit(1))
    hashes = F.transform(chains, lambda c: _hash(F.regexp_replace(c, f" {_MARK}\\S+", "")))
    return F.when(F.size(hashes) > 0, F.array_sort(F.array_distinct(hashes))).otherwise(F.array(_hash(F.concat(F.lit("whole text: "), plain))))


def _hash(value: Column) -> Column:
    return F.xxhash64(value).bitwiseAND(F.lit(0xFFFFFFFF))


def as_text(signatures: Column) -> Column:
    """A set as a string: eight hexadecimal digits for each signature, ascending."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a look at them where their lengths keep it below ``at_least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    value = shared / (F.size(a) + F.size(b) - shared)
    return F.when(F.lit(at_least > 0) & (small < F.lit(at_least) * large), F.lit(0.0)).otherwise(value)


def _blocks(docs: DataFrame, block_rows: int, most: int = 1 << 18) -> tuple[DataFrame, int]:
    """``docs`` with ``_block``, numbered by falling doc_id, and the number of rows: ranges of ids with about so many rows each, at most ``most`` blocks.

    Approximate quantiles give coarse ranges, which are cut into equal widths; so neither gaps nor outliers of the ids gather
    rows in one block. An id that is a quantile more than once holds a good part of the rows: it is a coarse range of its own, and so are the rows without an id, which come last;
    these are cut into equal widths of the hash of their text, falling as rows do.
    """
    facts = docs.agg(F.count("*").alias("n"), F.count("_id").alias("known"), F.percentile_approx("_id", [k / 64 for k in range(65)], 10_000).alias("q")).first()
    n, found = facts["n"], facts["q"] or [0]
    if n <= block_rows:
        return docs.withColumn("_block", F.lit(0).cast("long")), n
    often = {c: (found.count(c) + 1) / 64 * facts["known"] for c in sorted(set(found)) if found.count(c) > 1}  # with the most rows each can have
    cuts = sorted(set(found) | {c + 1 for c in often if c < 2**63 - 1})  # a range begins at its cut, so one of these ids fills its own

    def parts(size: float) -> tuple[int, dict[int, int], int]:
        """How many blocks of ``size`` rows a range, each frequent id and the rows without an id are cut into."""
        return math.ceil(facts["known"] / len(set(found)) / size) or 1, {c: math.ceil(rows / size) for c, rows in often.items()}, math.ceil((n - facts["known"]) / size) or 1

    fine, hashed, unknown = parts(block_rows)
    if (total := fine * (len(cuts) + 1) + sum(hashed.values()) + unknown) > most:
        fine, hashed, unknown = parts(block_rows * total / most)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    above = F.size(F.filter(bounds, lambda c: c > F.col("_id")))  # 0: from the last cut on
    low, high = F.element_at(bounds, F.lit(len(cuts)) - above), F.element_at(bounds, F.lit(len(cuts) + 1) - above)
    inside = (above > 0) & (above < len(cuts))
    within = (high.cast("double") - F.col("_id")) / (high.cast("double") - low)
    by_hash = (F.lit(2.0**63) - F.col("_hash")) / 2.0**64
    step = F.when(F.col("_id").isNull(), _part_of(by_hash, unknown))
    for c, k in hashed.items():
        step = step.when(F.col("_id") == F.lit(c).cast("long"), _part_of(by_hash, k))
    step = step.when(inside, _part_of(within, fine)).otherwise(0)
    place = F.when(F.col("_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above).cast("long")
    return docs.withColumn("_block", (place * max(fine, unknown, *hashed.values()) + step).cast("long")), n


def _part_of(share: Column, parts: int) -> Column:
    return F.least(F.greatest(F.floor(share * parts), F.lit(0)), F.lit(parts - 1))


def with_next(docs: DataFrame, block_rows: int = 1024, task_rows: int = 4096) -> DataFrame:
    """``_id, _text, _set, _next_text, _next_set``: each document with the next one by falling doc_id, the first one after the last.

    Blocks of ids are windows of their own, dealt to tasks of about ``task_rows`` rows, however many rows there are. What follows a block's last row is the next block's first, so a copy of that row
    goes to the block's end; there is one such row for each block. Equal ids follow by falling hash of their text, and so do rows without an id;
    blocks of these are ranges of hashes. Only rows that are equal in id and text cannot be told apart, and lie in one block.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_text"))
    rows, n = _blocks(rows.withColumn("_hash", F.xxhash64("_text")), block_rows)
    heads = rows.groupBy("_block").agg(F.max(F.struct("_id", "_hash")).alias("_head"))
    order = Window.orderBy("_block")  # sees one row for each block
    first = F.first("_head").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("_block").alias("_to"), F.coalesce(F.lead("_head").over(order), first).alias("_h"))
    heads = heads.select("_to", F.col("_h._id").alias("_hid"), F.col("_h._hash").alias("_hhash"))
    copies = rows.join(F.broadcast(heads), F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_hash") == F.col("_hhash")))  # at most 2**18 narrow rows
    copies = copies.dropDuplicates(["_to"]).select("_id", "_text", F.col("_to").alias("_block"), "_hash", F.lit(1).alias("_copy"))
    every = rows.withColumn("_copy", F.lit(0)).unionByName(copies).withColumn("_set", signature_set(F.col("_text")))
    every = every.repartition(max(1, math.ceil(n / task_rows)), "_block")
    window = Window.partitionBy("_block").orderBy("_copy", F.desc_nulls_last("_id"), F.desc("_hash"))
    out = every.withColumn("_next_text", F.lead("_text").over(window)).withColumn("_next_set", F.lead("_set").over(window))
    return out.where("_copy = 0").select("_id", "_text", "_set", "_next_text", "_next_set")


def fingerprints(docs: DataFrame, block_rows: int = 1024) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for each row of ``docs(doc_id, text)``.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document.
    Null texts are empty. Repeated rows follow each other; rows without an id come last; an only row is its own next; an empty
    table gives no rows; other columns are ignored.
    """
    rows = with_next(docs, block_rows)
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("_text"), F.lit(1), n - half), F.substr(F.col("_next_text"), F.lit(1), half))
    rows = rows.withColumn("_edited", edited).withColumn("_edited_set", signature_set(F.col("_edited")))
    return rows.select(
        F.col("_id").alias("doc_id"), F.length("_text").cast("long").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_set")).alias("fingerprint"), as_text(F.col("_edited_set")).alias("edited_fingerprint"),
        likeness(F.col("_set"), F.col("_edited_set")).alias("near_edited"), likeness(F.col("_set"), F.col("_next_set")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b, likeness`` (a < b) of class representatives, and the membership ``doc_id, class_id``.

    Equal sets are a class, represented by its smallest doc_id; representatives of likeness ``threshold`` or more are pairs. Sets
    are dealt by length partition: lengths grow by 1 / threshold from one to the next, so partners are in the same or the next
    one. A pair must share one of each set's rarest ``length - ceil(threshold * length) + 1`` signatures, and only these meet.
    Rows without a doc_id are left out.
    """
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), signature_set(F.col("text")).alias("set"))
    rows = rows.withColumn("_key", F.sha2(F.concat_ws(",", F.col("set").cast("array<string>")), 256))
    reps = rows.groupBy("_key").agg(F.min("doc_id").alias("rep"), F.first("set").alias("set"))
    members = rows.select("doc_id", "_key").join(reps.select("_key", F.col("rep").alias("class_id")), "_key").select("doc_id", "class_id")
    single = reps.select("rep", F.size("set").alias("n"), F.explode("set").alias("s"))
    seen = single.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    rank = single.join(seen, "s", "left").select("rep", "n", F.struct(F.coalesce("df", F.lit(1)).alias("df"), "s").alias("f"))
    prefix = rank.groupBy("rep", "n").agg(F.array_sort(F.collect_list("f")).alias("f"))
    keep = F.col("n") - F.ceil(F.col("n") * threshold).cast("int") + 1
    prefix = prefix.select("rep", "n", F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold)).cast("int").alias("p"), F.explode(F.slice("f", F.lit(1), keep)).alias("f"))
    prefix = prefix.where("f.df > 1").select("rep", "n", "p", F.col("f.s").alias("s"))
    left = prefix.select(F.col("rep").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(F.col("p"), F.col("p") + 1)).alias("p"))
    right = prefix.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "s", "p")
    met = left.join(right, ["s", "p"]).where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    met = met.where(F.col("na") >= threshold * F.col("nb")).select("a", "b").distinct()
    met = met.join(reps.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a").join(reps.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b")
    pairs = met.withColumn("likeness", likeness(F.col("sa"), F.col("sb"), threshold)).where(F.col("likeness") >= threshold - 1e-9)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"), members
