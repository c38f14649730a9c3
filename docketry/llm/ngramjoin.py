"""N-gram Jaccard self-join by MinHash banding.

A document is the set of its n-grams of words. Equal sets are one class from the start, and one representative of each
goes on. Representatives that agree on all rows of a band meet in that band's bucket; bands and rows are chosen for the target
recall at the threshold. A bucket gives one edge from each member to its smallest, never all pairs; connected by
these edges, candidates form groups that hold every pair that shares a bucket. Full n-gram sets travel once, to their
group, where all pairs are verified exactly by set intersection.

A group beyond a block's size is either split into blocks, and every pair of blocks verified by itself, or verified bucket by bucket (buckets split
in the same way), a pair only in the first band it shares: whichever sends fewer sets. A chain of many small buckets is cheap by bucket, a dense cluster
by group. No task holds more than two blocks however large a group or bucket is. Classes are the components of the verified links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import components, slices
from docketry.llm.langid import batches_of, mixed
from docketry.llm.wordhash import word_hashes
from docketry.operators.durable import checkpointed

_STEP = np.uint64(0xD6E8FEB86659FD93)


def choose_bands(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """Bands and rows: the most rows a band can have while a pair at the threshold is found with the target recall.

    A pair of Jaccard s shares one of b bands of r rows with probability 1 - (1 - s**r)**b. Raises ValueError if not even bands of one row
    reach the recall with so many hashes.
    """
    best = None
    for rows in range(1, most + 1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - chance))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"{most} hashes find a pair at {threshold} with a recall of {1 - (1 - threshold) ** most:.4f}, not {recall}")
    return best


def ngram_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text, one after the other, and their number by text.

    A text of fewer than n words (but at least one) has one n-gram, of all its words.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    begins = ends - counts
    size = max(0, len(words) - n + 1)
    grams = np.zeros(size, np.uint64)
    for k in range(n):
        grams = grams * _STEP + words[k : k + size]
    owner = np.repeat(np.arange(len(texts)), counts)
    whole = np.arange(size) + n <= ends[owner[:size]]
    grams, owners = mixed(grams[whole]), owner[:size][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, k in enumerate(short.tolist()):
            value = int(counts[k])
            for word in words[begins[k] : ends[k]].tolist():
                value = (value * int(_STEP) + word) & (1 << 64) - 1
            extra[i] = value
        grams, owners = np.concatenate([grams, mixed(extra)]), np.concatenate([owners, short])
    order = np.lexsort((grams, owners))
    grams, owners = grams[order], owners[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    return grams[fresh], np.bincount(owners[fresh], minlength=len(texts))


def signatures(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """For each non-empty set: two sums that identify it, and the hash of each band of its MinHash signature."""
    full = counts[counts > 0]
    starts = np.cumsum(full) - full
    keys = np.stack([np.add.reduceat(mixed(grams + np.uint64(k)), starts) for k in (1, 2)], 1) if len(full) else np.zeros((0, 2), np.uint64)
    draw = np.random.default_rng(seed)
    factors = draw.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = draw.integers(0, 1 << 63, bands * rows, np.uint64)
    out = np.zeros((len(full), bands), np.uint64)
    for k in range(bands * rows if len(full) else 0):
        least = np.minimum.reduceat((grams ^ offsets[k]) * factors[k], starts)
        out[:, k // rows] = mixed(out[:, k // rows] * _STEP + least)
    return keys, out


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``_id, _text_hash, size, k1, k2, bands`` for each row; sizes, keys and bands are null for a row without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            size, keys, hashes = [], [], []
            for _, part in batches_of(batch.column(2).to_pylist()):
                grams, counts = ngram_sets(part, n)
                own_keys, own_bands = signatures(grams, counts, bands, rows)
                size.append(counts)
                at = np.full(len(part), -1)
                at[counts > 0] = np.arange(len(own_keys))
                keys += [own_keys[i].view(np.int64).tolist() if i >= 0 else [None, None] for i in at.tolist()]
                hashes += [own_bands[i].view(np.int64).tolist() if i >= 0 else None for i in at.tolist()]
            sizes = np.concatenate(size) if size else np.zeros(0, np.int64)
            columns = [pa.array(sizes, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_id", "_text_hash", "size", "k1", "k2", "bands"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows_ = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_text_hash"), text.alias("_text"))
    return rows_.mapInArrow(run, "_id long, _text_hash long, size long, k1 long, k2 long, bands array<long>")


def intersections(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """How many values each two of the sets share, by products of membership matrices over chunks of shared values."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    place = np.cumsum(times > 1) - 1
    owner, column = owner[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32 if len(sets) and max(map(len, sets)) < 1 << 24 else np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        a, b = np.searchsorted(column, [at, at + chunk])
        member = np.zeros((len(sets), min(chunk, int(column[-1]) + 1 - at)), total.dtype)
        member[owner[a:b], column[a:b] - at] = 1
        total += member @ member.T
    return total


def linked(sets: list[np.ndarray], threshold: float, sides: list[int] | None = None) -> np.ndarray:
    """Whether each two sets are at least so similar; with sides given, only sets of different sides are compared."""
    sizes = np.array([len(s) for s in sets], float)
    shared = intersections(sets).astype(float)
    out = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(out, False)
    if sides is not None:
        side = np.array(sides)
        out &= side[:, None] != side[None, :]
    return out


def _roots(link: np.ndarray, ids: list[int]) -> list[int]:
    """The smallest id connected to each member."""
    left, roots = set(range(len(ids))), list(ids)
    while left:
        group, front = [], [left.pop()]
        while front:
            k = front.pop()
            group.append(k)
            near = [j for j in np.flatnonzero(link[k]).tolist() if j in left]
            left.difference_update(near)
            front += near
        least = min(ids[k] for k in group)
        for k in group:
            roots[k] = least
    return roots


def _verified(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """``rep, links, root`` for each member of each group (place, band, low, high): copies linked to it, and the smallest id it is connected to there.

    A bucket (its band is 0 or more) leaves out the pairs that have met in a band before.
    """

    def judged(rows: list[tuple]) -> tuple[list, list, list]:
        rows = list({row[4]: row for row in rows}.values())  # a document read twice is one member
        ids, copies, sides = [r[4] for r in rows], np.array([r[5] for r in rows]), [r[6] for r in rows]
        if len(rows) < 2:
            return ids, [0] * len(ids), ids
        _, band, low, high = rows[0][:4]
        link = linked([np.frombuffer(r[7], np.uint64) for r in rows], threshold, sides if low != high else None)
        for own in np.array([r[8][:band] for r in rows], np.int64).T if band > 0 else ():
            link &= own[:, None] != own[None, :]
        return ids, (link @ copies).tolist(), _roots(link, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, key = ["rep", "links", "root"], [], None
        out: list[list] = [[], [], []]

        def take() -> None:
            for column, values in zip(out, judged(held), strict=True):
                column.extend(values)
            held.clear()

        def full() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
            for column in out:
                column.clear()
            return made

        for batch in slices(batches):
            for row in zip(*(batch.column(k).to_pylist() for k in range(9)), strict=True):
                if row[:4] != key:
                    if held:
                        take()
                    key = row[:4]
                    if len(out[0]) > 20_000:
                        yield full()
                held.append(row)
        if held:
            take()
        if out[0]:
            yield full()

    keys = ["place", "band", "low", "high"]
    groups = members.repartition(*keys).sortWithinPartitions(*keys, "rep")
    return groups.select(*keys, "rep", "copies", "block", "set", "bands").mapInArrow(run, "rep long, links long, root long")


def _with_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``wanted(rep, first_id, k1, k2, ...)`` with each representative's n-gram set, from the row of that id that has this set."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("_text")).join(wanted, F.col("_id") == F.col("first_id")).select("_text", *wanted.columns)
    names = list(wanted.columns)
    at = 1 + names.index("k1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, sets = batch.column(0).to_pylist(), []
            k1, k2 = batch.column(at).to_pylist(), batch.column(at + 1).to_pylist()
            for begin, part in batches_of(texts):
                grams, counts = ngram_sets(part, n)
                keys = np.zeros((len(part), 2), np.uint64)
                keys[counts > 0] = signatures(grams, counts, 1, 1)[0]
                ends = np.cumsum(counts)
                for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
                    own = keys[i].view(np.int64).tolist() == [k1[begin + i], k2[begin + i]]
                    sets.append(grams[a:b].tobytes() if own else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())], [*names, "set"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields) + ", set binary"
    return rows.mapInArrow(run, schema).where("set is not null")


def _placed(reps: DataFrame, slots: DataFrame, meets: DataFrame, groups: DataFrame, block_members: int, block_grams: int) -> DataFrame:
    """``rep, first_id, k1, k2, copies, bands, places`` of the candidates; places are structs (place, band, parts) where a representative's pairs are verified.

    That is its group (band -1), or each of its buckets if the group is larger than a block and its buckets send fewer sets. ``bands`` is null
    for the former.
    """

    def parts(n: str, grams: str) -> Column:
        return F.ceil(F.greatest(F.col(n) / block_members, F.col(grams) / block_grams)).cast("int")

    grouped = reps.join(groups, F.col("rep") == F.col("id")).select("rep", "first_id", "k1", "k2", "copies", "size", "bands", F.col("component").alias("comp"))
    sizes = grouped.groupBy(F.col("comp").alias("_c")).agg(F.count("*").alias("_n"), F.sum("size").alias("_g"))
    sizes = checkpointed(sizes.select("_c", "_n", parts("_n", "_g").alias("_parts")))
    grouped = checkpointed(grouped.join(sizes, F.col("comp") == F.col("_c")).drop("_c"))
    large = grouped.where("_parts > 1").select(F.col("rep").alias("_r"), "comp", "size")
    inside = slots.join(large, F.col("rep") == F.col("_r")).join(meets.select(F.col("band").alias("_b"), F.col("slot").alias("_s")), (F.col("band") == F.col("_b")) & (F.col("slot") == F.col("_s")))
    inside = checkpointed(inside.select("rep", "comp", "size", "band", "slot"))
    buckets = inside.groupBy(F.col("comp").alias("_c"), F.col("band").alias("_b"), F.col("slot").alias("_s")).agg(F.count("*").alias("_n"), F.sum("size").alias("_g"))
    buckets = checkpointed(buckets.select("_c", "_b", "_s", "_n", parts("_n", "_g").alias("parts")))
    sent = buckets.groupBy("_c").agg(F.sum(F.col("_n") * F.col("parts")).alias("_sent"))
    split = sent.join(sizes.select(F.col("_c").alias("comp"), (F.col("_n") * F.col("_parts")).alias("_whole")), F.col("_c") == F.col("comp")).where("_sent < _whole").select(F.col("comp").alias("_split"))
    split = checkpointed(split)
    own = buckets.join(split, F.col("_c") == F.col("_split"), "left_semi")
    by_bucket = inside.join(own, (F.col("comp") == F.col("_c")) & (F.col("band") == F.col("_b")) & (F.col("slot") == F.col("_s")))
    by_bucket = by_bucket.groupBy(F.col("rep").alias("_r")).agg(F.collect_list(F.struct(F.col("slot").alias("place"), F.col("band").cast("int").alias("band"), "parts")).alias("_places"))  # a struct for each band at most
    placed = grouped.join(by_bucket, F.col("rep") == F.col("_r"), "left")
    whole = F.array(F.struct(F.col("comp").alias("place"), F.lit(-1).alias("band"), F.col("_parts").alias("parts")))
    return checkpointed(placed.select("rep", "first_id", "k1", "k2", "copies", F.when(F.col("_places").isNotNull(), F.col("bands")).alias("bands"), F.coalesce("_places", whole).alias("places")))


def _classes(docs: DataFrame, n: int, threshold: float, recall: float, most_hashes: int, block_members: int, block_grams: int) -> DataFrame:
    """``_id, _text_hash, root, class_id, n_links`` for each row; a root is one class, null for rows that cannot be linked."""
    bands, rows = choose_bands(threshold, recall, most_hashes)
    signed = checkpointed(_signed(docs, n, bands, rows))
    usable = signed.where("size > 0 and _id is not null")
    reps = usable.groupBy("k1", "k2").agg(F.min("_id").alias("first_id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    reps = checkpointed(reps.withColumn("rep", F.monotonically_increasing_id()))  # written, so the numbers stay
    slots = reps.select("rep", F.posexplode("bands").alias("band", "slot"))
    meets = checkpointed(slots.groupBy("band", "slot").agg(F.min("rep").alias("least"), F.count("*").alias("n")).where("n > 1"))  # so that the join's skew can be split
    edges = slots.join(meets, ["band", "slot"]).where("rep != least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    groups = components(edges)

    wanted = _placed(reps, slots, meets, groups, block_members, block_grams)
    members = _with_sets(docs, wanted, n).select("rep", "copies", "set", "bands", F.explode("places").alias("p")).select("rep", "copies", "set", "bands", "p.*")
    members = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int"))
    members = members.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_other"))
    members = members.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
    found = checkpointed(_verified(members, n, threshold))
    links = found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    if wanted.where("size(places) > 1 or places[0].parts > 1 or places[0].band >= 0").limit(1).count():
        split = components(found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
        links = links.join(split, F.col("_rep") == F.col("id"), "left").select("_rep", "links", F.coalesce("component", "root").alias("root"))
    rooted = reps.join(links, F.col("rep") == F.col("_rep"), "left").select(
        "k1", "k2", "first_id", F.coalesce("root", "rep").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    names = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("class_id"))
    classes = rooted.join(names, F.col("root") == F.col("_root")).select("k1", "k2", "root", "class_id", "n_links")
    linked_ = usable.select("_id", "_text_hash", "k1", "k2").join(classes, ["k1", "k2"]).select("_id", "_text_hash", "root", "class_id", "n_links")
    alone = signed.where("size = 0 or _id is null").select("_id", "_text_hash", F.lit(None).cast("long").alias("root"), F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return linked_.unionByName(alone)


def near_duplicates(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, most_hashes: int = 128, block_members: int = 256, block_grams: int = 2_000_000
) -> DataFrame:
    """``doc_id, class_id, n_links`` for each row of ``docs(doc_id, text)``.

    ``n_links`` is the number of other rows whose n-gram set has a Jaccard similarity of ``threshold`` or more, copies
    included; ``class_id`` the smallest doc_id that links lead to. Texts without a word (null and empty ones too) and rows without a
    doc_id have no links and are their own class. Repeated rows are copies of each other, and rows of one doc_id with different
    texts are documents of their own. An empty table gives no rows; other columns are ignored.
    """
    return _classes(docs, n, threshold, recall, most_hashes, block_members, block_grams).select(F.col("_id").alias("doc_id"), "class_id", "n_links")


def deduplicated(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, most_hashes: int = 128, block_members: int = 256, block_grams: int = 2_000_000
) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: its smallest doc_id stays.

    Rows without a doc_id and texts without a word stay. Of a doc_id's repeated equal rows one stays.
    """
    found = _classes(docs, n, threshold, recall, most_hashes, block_members, block_grams).where("root is not null")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    wordless = ~F.coalesce(F.lower(text).rlike(r"[a-z0-9]|[^\x00-\x7F]"), F.lit(False))
    kept = checkpointed(found.groupBy("root").agg(F.min(F.struct("_id", "_text_hash")).alias("k"), F.count("*").alias("n")).select(F.col("k._id").alias("__kept_id"), F.col("k._text_hash").alias("__kept_hash"), "n"))
    rows = docs.withColumn("__free", F.col("doc_id").isNull() | wordless).withColumn("__hash", F.xxhash64(text))
    joined = rows.where("not __free").join(kept, (F.col("doc_id") == F.col("__kept_id")) & (F.col("__hash") == F.col("__kept_hash")), "left_semi")
    repeated = found.groupBy("_id", "_text_hash").agg(F.count("*").alias("times")).where("times > 1")
    if repeated.limit(1).count():  # rows that no column tells apart; with unique ids there are none
        joined = joined.dropDuplicates(["doc_id", "__hash"])
    return joined.unionByName(rows.where("__free")).select(*docs.columns)
