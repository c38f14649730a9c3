"""The queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import changepoints, collocations, langid, media, mixing, ngramjoin, packing, secrets, spotsigs, tokencount, topk, toxicity, urlfilter


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file() -> str:
    """The vocabulary file of the registered queries; the operators take any path."""
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_file(), window=1024, end_id=0)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_read(spark, sf_dir, "documents"), tokenizer_file(), limit=512)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, repeats=2)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(_read(spark, sf_dir, "documents"))


def op7_media_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(_read(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(_read(spark, sf_dir, "documents"), n=5, threshold=0.8)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_read(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"), asks=F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op12_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changepoints.vendor_change_points(_read(spark, sf_dir, "sale_lines"), flags=("kept", "swapped"), least=5, penalty=10_000)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"), longest=3, least=10, most=2000, absorbed=0.5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_nnls_packing": op2_nnls_packing,
    "op3_token_counts": op3_token_counts,
    "op4_source_mixing": op4_source_mixing,
    "op5_secret_scan": op5_secret_scan,
    "op6_spot_signatures": op6_spot_signatures,
    "op7_media_sequences": op7_media_sequences,
    "op8_ngram_join": op8_ngram_join,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_topk_search": op11_topk_search,
    "op12_change_points": op12_change_points,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op8_ngram_join": r"""
        WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS words FROM documents),
        g AS (
            SELECT r, doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END) AS gram
            FROM w WHERE doc_id IS NOT NULL),
        n AS (SELECT r, doc_id, count(*) AS n FROM g GROUP BY ALL),
        shared AS (SELECT gram FROM g GROUP BY gram HAVING count(*) > 1),
        s AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM (SELECT * FROM g SEMI JOIN shared USING (gram)) a JOIN (SELECT * FROM g SEMI JOIN shared USING (gram)) b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL),
        l AS (SELECT a, b FROM s JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE k >= 0.8::DOUBLE * (x.n + y.n - k) - 1e-9),
        reach(r, t) AS (SELECT a, a FROM l UNION SELECT reach.r, l.b FROM reach JOIN l ON l.a = reach.t),
        c AS (SELECT reach.r, min(w.doc_id) AS class_id FROM reach JOIN w ON w.r = reach.t GROUP BY reach.r),
        d AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
        SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links FROM w LEFT JOIN c ON c.r = w.r LEFT JOIN d ON d.r = w.r""",
    "op4_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS turn
            FROM d GROUP BY source),
        w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][turn % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
        c AS (
            SELECT *, cap / weight AS per,
                   coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                   sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
                   sum(source_size) OVER () * 1.5::DOUBLE AS budget
            FROM w),
        l AS (SELECT max((budget - capped) / open_weight) FILTER ((budget - capped) / open_weight <= per) AS level FROM c),
        t AS (SELECT source, source_size, least(coalesce(level * weight, cap), cap) AS target FROM c, l),
        r AS (
            SELECT doc_id, size, source_size, target, floor(target + 1e-6)::BIGINT AS stop,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (greatest(0, least(size, stop - begins)) + greatest(0, least(size, stop - begins - source_size)))::BIGINT AS taken
        FROM r""",
    "op11_topk_search": r"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 5""",
    "op12_change_points": r"""
        WITH RECURSIVE d AS MATERIALIZED (
            SELECT vendor_id, date_diff('day', DATE '1970-01-01', shipped_at::DATE) AS day, sum(quantity)::HUGEINT AS x
            FROM sale_lines WHERE flag IN ('kept', 'swapped') AND quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL),
        v AS MATERIALIZED (SELECT dense_rank() OVER (ORDER BY vendor_id NULLS LAST) AS g, vendor_id, min(day) AS first, max(day) - min(day) + 1 AS n FROM d GROUP BY vendor_id),
        x AS MATERIALIZED (
            SELECT g, i, n, coalesce(x, 0) AS x FROM (SELECT g, vendor_id, first, n, unnest(range(n)) AS i FROM v) e
            LEFT JOIN d ON d.vendor_id IS NOT DISTINCT FROM e.vendor_id AND d.day = e.first + e.i),
        p AS MATERIALIZED (
            SELECT g, i + 1 AS j, n, sum(x) OVER w AS s, sum(x * x) OVER w AS q FROM x WINDOW w AS (PARTITION BY g ORDER BY i)
            UNION ALL SELECT g, 0, n, 0, 0 FROM v),
        m AS MATERIALIZED (
            SELECT a.g, a.j AS i, b.j, a.n AS whole, b.j - a.j AS n, (b.s - a.s)::HUGEINT AS s, (b.q - a.q)::HUGEINT AS q
            FROM p a JOIN p b ON a.g = b.g AND (b.j - a.j >= 5 OR (a.j = 0 AND b.j = a.n AND a.n < 5))),
        c AS MATERIALIZED (
            SELECT g, i, j, whole, n, s, spread, n * floor(1000 * ln(spread::DOUBLE))::BIGINT AS cost
            FROM (SELECT *, 1 + (n * q - s * s) // (n * n)::HUGEINT AS spread FROM m)),
        b(g, k, j, best, i) AS (
            SELECT g, 1::BIGINT, j, cost, 0::BIGINT FROM c WHERE i = 0
            UNION ALL
            SELECT g, k, j, z.t, z.i FROM (
                SELECT b.g, b.k + 1 AS k, c.j, min(struct_pack(t := b.best + c.cost, i := c.i)) AS z
                FROM b JOIN c ON c.g = b.g AND c.i = b.j GROUP BY ALL)),
        e AS MATERIALIZED (
            SELECT g, n, z.k, z.best FROM (
                SELECT v.g, v.n, min(struct_pack(best := b.best + 10000 * (b.k - 1), k := b.k)) AS z FROM b JOIN v ON v.g = b.g AND v.n = b.j GROUP BY ALL)),
        t(g, k, i, j) AS (
            SELECT e.g, e.k, b.i, b.j FROM e JOIN b ON b.g = e.g AND b.k = e.k AND b.j = e.n
            UNION ALL
            SELECT b.g, b.k, b.i, b.j FROM t JOIN b ON b.g = t.g AND b.k = t.k - 1 AND b.j = t.i)
        SELECT vendor_id, t.k::INTEGER AS segment_no, (first + t.i)::BIGINT AS first_day, c.n::BIGINT AS n_days, c.s::BIGINT AS total, c.spread::BIGINT AS spread, c.cost::BIGINT AS cost,
               e.k::BIGINT AS n_segments, e.best::BIGINT AS best_cost
        FROM t JOIN c ON c.g = t.g AND c.i = t.i AND c.j = t.j JOIN e ON e.g = t.g JOIN v ON v.g = t.g""",
    "op13_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
        h AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
        t AS MATERIALIZED (SELECT lang, sum(n)::BIGINT AS n FROM h WHERE k = 1 GROUP BY lang),
        f AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM h WHERE n >= 10),
        c AS MATERIALIZED (SELECT * FROM f WHERE k >= 2),
        u AS (
            SELECT c.lang, c.k, c.phrase, c.n AS a, l.k AS cut, l.n AS l, r.n AS r, (1000000::HUGEINT * c.n::HUGEINT * c.n::HUGEINT) // (l.n::HUGEINT * r.n::HUGEINT) AS score
            FROM c JOIN f l ON l.lang = c.lang AND l.k < c.k AND l.phrase = array_to_string(c.w[1:l.k], ' ')
            JOIN f r ON r.lang = c.lang AND r.k = c.k - l.k AND r.phrase = array_to_string(c.w[l.k + 1:], ' ')),
        s AS (SELECT lang, k, phrase, a, min(struct_pack(score := score, cut := cut, l := l, r := r)) AS z FROM u GROUP BY ALL),
        i AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, n FROM c WHERE k = 3),
        o AS (SELECT s.* FROM s WHERE k = 3 OR NOT EXISTS (SELECT 1 FROM i WHERE i.lang = s.lang AND i.phrase = s.phrase AND 100 * i.n >= 50 * s.a)),
        q AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY z.score DESC, a DESC, phrase) AS rank, phrase, a, z.l AS l, z.r AS r, z.score AS score FROM o)
        SELECT q.lang, rank::INTEGER AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score FROM q JOIN t ON t.lang = q.lang WHERE rank <= 2000""",
}
