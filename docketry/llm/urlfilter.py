"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest.

Features come from SQL functions, and the trees are scored as one SQL expression, so the rows stay in the engine. The
trees are grown on the driver from a bounded sample of labelled URLs, those that a rule decides; suffix statistics are counted over all of them and
stay in tables that are joined by key.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.operators.durable import checkpointed, shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host, path of the registered rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
FEATURES = ("url_chars", "path_depth", "digit_ratio", "entropy", "parameters", "host_labels", "host_chars", "path_chars", "suffix_rate", "domain_rate", "section_rate")
#: What block rates are counted by: the last label of the host, the last two, and the last label with the path's first segment.
STATISTICS = ("suffix", "domain", "section")
#: Weight of the overall block rate in a suffix's own, in rows.
PRIOR_ROWS = 4


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host_: Column, path_: Column, rules=RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits: its host or a subdomain, and its path as a prefix."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, own_host, own_path in ordered:
        fits = ((host_ == own_host) | host_.endswith("." + own_host)) & path_.startswith(own_path)
        out = out.when(fits, F.struct(F.lit(own_host + own_path).alias("rule"), F.lit(verdict).alias("verdict")))
    return out


def entropy(text: Column) -> Column:
    """Bits per character of a text's own character distribution; 0 for an empty one."""
    n = F.length(text).cast("double")

    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    distinct = F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)))
    return F.coalesce(F.aggregate(distinct, F.lit(0.0), lambda total, c: total + part(c)), F.lit(0.0))


def lexical(pages: DataFrame) -> DataFrame:
    """``_id, host, path``, the rule's ``decided`` struct and the lexical features of each row of ``pages``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").alias("_id"), url.alias("_url"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    query = F.regexp_extract("_url", r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    segments = F.filter(F.split("path", "/"), lambda p: p != "")
    section = F.concat(F.element_at(labels, -1), F.lit("/"), F.coalesce(F.get(segments, F.lit(0)), F.lit("")))
    return rows.select(
        "_id", "host", "path", section.alias("_section"), matched(F.col("host"), F.col("path")).alias("decided"),
        F.element_at(labels, -1).alias("_suffix"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("_domain"),
        F.length("_url").cast("double").alias("url_chars"),
        F.size(segments).cast("double").alias("path_depth"),
        (F.length(F.regexp_replace("_url", r"[^0-9]", "")) / F.greatest(F.length("_url"), F.lit(1))).alias("digit_ratio"),
        entropy(F.col("_url")).alias("entropy"),
        F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))).cast("double").alias("parameters"),
        F.size(labels).cast("double").alias("host_labels"),
        F.length("host").cast("double").alias("host_chars"),
        F.length("path").cast("double").alias("path_chars"),
    )


@dataclass
class Tree:
    """A split (feature, at most this goes left) or, without a feature, a leaf's value."""

    value: float = 0.0
    feature: str = ""
    most: float = 0.0
    sides: list = field(default_factory=list)

    def expression(self) -> Column:
        if not self.feature:
            return F.lit(float(self.value))
        left, right = self.sides
        return F.when(F.col(self.feature) <= F.lit(float(self.most)), left.expression()).otherwise(right.expression())

    def of(self, row: dict) -> float:
        tree = self
        while tree.feature:
            tree = tree.sides[0 if row[tree.feature] <= tree.most else 1]
        return tree.value


def _grown(rows: list[dict], gradient: list[float], hessian: list[float], index: list[int], depth: int, cuts: dict[str, list[float]], ridge: float) -> Tree:
    """A regression tree on first and second derivatives, split where the loss falls most."""
    g, h = sum(gradient[i] for i in index), sum(hessian[i] for i in index)
    best = (1e-6, "", 0.0)
    if depth and len(index) > 1:
        for name, places in cuts.items():
            bins = [[0.0, 0.0] for _ in range(len(places) + 1)]
            for i in index:
                k = rows[i]["_bins"][name]
                bins[k][0] += gradient[i]
                bins[k][1] += hessian[i]
            a = b = 0.0
            for place, (dg, dh) in zip(places, bins, strict=False):
                a, b = a + dg, b + dh
                if b > 0.5 and h - b > 0.5:
                    gain = a * a / (b + ridge) + (g - a) ** 2 / (h - b + ridge) - g * g / (h + ridge)
                    best = max(best, (gain, name, place))
    if not best[1]:
        return Tree(value=-g / (h + ridge))
    _, name, place = best
    left, right = [i for i in index if rows[i][name] <= place], [i for i in index if rows[i][name] > place]
    return Tree(feature=name, most=place, sides=[_grown(rows, gradient, hessian, side, depth - 1, cuts, ridge) for side in (left, right)])


@dataclass
class UrlModel:
    """Prior log-odds, trees, and tables ``key, value`` of the smoothed block rates by statistic."""

    prior: float
    trees: list[Tree]
    rates: dict[str, DataFrame]
    base_rate: float
    learning_rate: float

    def probability(self) -> Column:
        total = F.lit(float(self.prior))
        for tree in self.trees:
            total = total + F.lit(self.learning_rate) * tree.expression()
        return 1 / (1 + F.exp(-total))

    def probability_of(self, row: dict) -> float:
        return 1 / (1 + math.exp(-(self.prior + sum(self.learning_rate * tree.of(row) for tree in self.trees))))

    def scored(self, rows: DataFrame) -> DataFrame:
        """Rows of :func:`lexical` with their suffix statistics (the base rate for what was never counted) and ``block_score``."""
        for kind, table in self.rates.items():
            rows = rows.join(table.toDF(f"_{kind}_key", f"_{kind}_value"), F.col(f"_{kind}") == F.col(f"_{kind}_key"), "left")
            rows = rows.withColumn(f"{kind}_rate", F.coalesce(f"_{kind}_value", F.lit(self.base_rate))).drop(f"_{kind}_key", f"_{kind}_value")
        return rows.withColumn("block_score", self.probability())


def _smoothed(blocked: Column, n: Column, base: float) -> Column:
    return (blocked + F.lit(PRIOR_ROWS * base)) / (n + F.lit(PRIOR_ROWS))


def train(labelled: DataFrame, rounds: int = 20, depth: int = 3, learning_rate: float = 0.3, sample_rows: int = 5000, ridge: float = 1.0, bins: int = 16, folds: int = 5) -> UrlModel:
    """Boosted trees for ``block`` from rows of :func:`lexical` that a rule decides.

    Block rates by suffix, domain and section are counted over all decided rows. The trees are grown on a sample, the rows whose
    hash falls below a threshold set for ``sample_rows`` rows on average; no more ever reaches the driver. A sampled row gets the rates of
    the other folds of hosts, so that neither its own label nor those of its host's other URLs give it away.
    """
    names = [n for n in FEATURES if not n.endswith("_rate")]
    keys = [f"_{kind}" for kind in STATISTICS]
    decided = labelled.where("decided is not null").withColumn("_y", (F.col("decided.verdict") == "block").cast("long")).withColumn("_fold", F.pmod(F.xxhash64("host"), F.lit(folds)))
    cells = checkpointed(decided.groupBy(*keys, "_fold").agg(F.count("*").alias("n"), F.sum("_y").alias("blocked")))
    sums = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")).first()
    base = (sums["blocked"] + 1) / (sums["n"] + 2)
    share = min(1.0, sample_rows / max(1, sums["n"]))
    sample = decided.where(F.pmod(F.xxhash64("_id", "host", "path"), F.lit(1 << 20)) < F.lit(share * (1 << 20))).select("_y", "_fold", *keys, *names)
    rates, folder = {}, f"{shared_folder(labelled.sparkSession)}/url-rates-{uuid.uuid4().hex}"
    for kind, key in zip(STATISTICS, keys, strict=True):
        total = cells.groupBy(F.col(key).alias("_k")).agg(F.sum("n").alias("_n"), F.sum("blocked").alias("_b"))
        own = cells.groupBy(F.col(key).alias("_ok"), F.col("_fold").alias("_of")).agg(F.sum("n").alias("_on"), F.sum("blocked").alias("_ob"))
        sample = sample.join(total, F.col(key) == F.col("_k")).join(own, (F.col(key) == F.col("_ok")) & (F.col("_fold") == F.col("_of")))
        sample = sample.withColumn(f"{kind}_rate", _smoothed(F.col("_b") - F.col("_ob"), F.col("_n") - F.col("_on"), base)).drop("_k", "_n", "_b", "_ok", "_of", "_on", "_ob")
        total.select(F.col("_k").alias("key"), _smoothed(F.col("_b"), F.col("_n"), base).alias("value")).write.parquet(f"{folder}/{kind}")
        rates[kind] = labelled.sparkSession.read.schema("key string, value double").parquet(f"{folder}/{kind}")  # a written table, so that the planner knows its size
    rows = sorted((r.asDict() for r in sample.select("_y", *FEATURES).collect()), key=lambda r: tuple(r.values()))
    y = [float(r["_y"]) for r in rows]
    cuts = {}
    for name in FEATURES:
        values = sorted(r[name] for r in rows)
        cuts[name] = sorted({values[k * (len(values) - 1) // bins] for k in range(1, bins)}) if values else []
    for r in rows:
        r["_bins"] = {name: sum(r[name] > c for c in places) for name, places in cuts.items()}
    prior = math.log(base / (1 - base))
    margin, trees = [prior] * len(rows), []
    for _ in range(rounds if 0 < sum(y) < len(y) else 0):
        chance = [1 / (1 + math.exp(-m)) for m in margin]
        tree = _grown(rows, [p - t for p, t in zip(chance, y, strict=True)], [p * (1 - p) for p in chance], list(range(len(rows))), depth, cuts, ridge)
        trees.append(tree)
        margin = [m + learning_rate * tree.of(r) for m, r in zip(margin, rows, strict=True)]
    return UrlModel(prior, trees, rates, base, learning_rate)


def held_out(pages: DataFrame, one_in: int = 5, **options) -> tuple[float, float, int]:
    """Accuracy of the trees on the decided URLs of hosts that they did not learn from, the share of their commoner verdict, and their number."""
    rows = lexical(pages).withColumn("_test", F.pmod(F.xxhash64("host", F.lit("held out")), F.lit(one_in)) == 0)
    model = train(rows.where("not _test"), **options)
    found = model.scored(rows.where("_test and decided is not null")).withColumn("_block", F.col("decided.verdict") == "block")
    r = found.agg(F.avg(((F.col("block_score") >= 0.5) == F.col("_block")).cast("int")).alias("a"), F.avg(F.col("_block").cast("int")).alias("b"), F.count("*").alias("n")).first()
    return r["a"], max(r["b"], 1 - r["b"]), r["n"]


def judge(pages: DataFrame, model: UrlModel | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` for each row of ``pages(page_id, url)``.

    A rule's verdict stands; elsewhere the trees block at a probability of a half. A null or malformed URL has empty host
    and path and no rule, and is judged by the trees. Repeated rows are judged each; an empty table gives no rows; other
    columns are ignored. Suffix statistics are joined by key; unknown suffixes get the base rate.
    """
    rows = lexical(pages)
    rows = (model or train(rows)).scored(rows)
    verdict = F.coalesce("decided.verdict", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return rows.select(F.col("_id").alias("page_id"), "host", "path", F.col("decided.rule").alias("rule"), verdict.alias("verdict"), "block_score")
