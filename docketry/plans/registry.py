"""The registered queries of the engine's own operators, with equivalent SQL where SQL can express them.

The tables carry no form titles, stamps or file names, so those are derived from their columns by the same rule in the query and in
its SQL; each query runs over its whole table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import category as categories
from docketry.functions import dates, display, filer, text
from docketry.operators import boilerplate, dedup, naming, rollup, search, syncplan
from docketry.plans import corpus, publish
from docketry.plans.registered import ORACLE_SQL, QUERIES, made_once, registered
from docketry.plans.registered import read as _read
from docketry.plans.request import SearchRequest
from docketry.sources import tables


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a path by source, a name that some share, the text's hash, and for two of three a text."""
    name = F.concat(F.lit("d"), (F.col("doc_id") % 7).cast("string"), F.lit(".pdf"))
    path = F.concat("source", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("/"), name)
    return _documents(spark, sf_dir).select(
        path.alias("path"), F.sha2("text", 256).alias("sha256"), F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("t"), F.col("doc_id").cast("string"))).alias("text_path"), "doc_id"
    )


_FILES_SQL = """files AS (
    SELECT source || '/' || lpad(doc_id::VARCHAR, 12, '0') || '/d' || (doc_id % 7) || '.pdf' AS path, sha256(text) AS sha256,
           CASE WHEN doc_id % 3 <> 0 THEN 't' || doc_id END AS text_path, 'd' || (doc_id % 7) || '.pdf' AS name, doc_id
    FROM documents)"""


@registered("""
    WITH d AS (SELECT sha256(text) AS sha, min({'doc_id': doc_id, 'lang': lang, 'source': source}) AS d FROM documents GROUP BY 1)
    SELECT 'lang' AS facet, d.lang AS value, count(*) AS n FROM d WHERE d.source IN ('src0', 'src1', 'src2') GROUP BY 2
    UNION ALL
    SELECT 'source', d.source, count(*) FROM d WHERE d.lang IN ('en', 'de') GROUP BY 2""")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents deduplicated by content, those by language among three sources and by source among two languages."""
    distinct = _documents(spark, sf_dir).groupBy(F.sha2("text", 256).alias("sha")).agg(F.min(F.struct("doc_id", "lang", "source")).alias("d"))
    found = distinct.select(F.create_map(F.lit("category"), F.array("d.lang"), F.lit("year"), F.array("d.source")).alias("filters"))
    counts = search.facet_counts(found, {"category": ("en", "de"), "year": ("src0", "src1", "src2")})
    return counts.select(F.when(F.col("facet") == "category", "lang").otherwise("source").alias("facet"), "value", "n")


@registered(f"""
    WITH {_FILES_SQL}, n AS (SELECT sha256, name, min(path) AS first FROM files GROUP BY ALL)
    SELECT f.sha256, min(f.path) AS first_path, (SELECT list(name ORDER BY first) FROM n WHERE n.sha256 = f.sha256) AS filenames,
           arg_min(f.path, f.path) FILTER (f.text_path IS NOT NULL) AS original_path, arg_min(f.text_path, f.path) FILTER (f.text_path IS NOT NULL) AS text_path
    FROM files f GROUP BY f.sha256""")
def dedup_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each content hash, with its names in path order and its first copy that has a text."""
    return dedup.documents(_files(spark, sf_dir))


@registered(f"""
    WITH {_FILES_SQL} SELECT path, sha256 FROM files f
    WHERE text_path IS NULL AND NOT EXISTS (SELECT 1 FROM files g WHERE g.sha256 = f.sha256 AND g.text_path IS NOT NULL)""")
def missing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of documents that no copy has a text of."""
    files = _files(spark, sf_dir)
    return dedup.missing_texts(files, dedup.documents(files))


@registered(f"""
    WITH {_FILES_SQL}, gone AS (SELECT DISTINCT f.sha256 FROM files f JOIN labels l ON f.doc_id = l.doc_id WHERE toxic = 1)
    SELECT doc_id, sha256 FROM files f WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.sha256 = f.sha256)""")
def exclusion_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without those whose content is on an exclusion list."""
    files = _files(spark, sf_dir)
    gone = files.join(_read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id").select("sha256")
    return dedup.without_excluded(files, gone).select("doc_id", "sha256")


@registered(f"""
    WITH {_FILES_SQL}, gone AS (SELECT DISTINCT f.sha256 FROM files f JOIN labels l ON f.doc_id = l.doc_id WHERE toxic = 1),
         kept AS (SELECT * FROM files WHERE sha256 NOT IN (SELECT sha256 FROM gone)),
         docs AS (SELECT sha256, count(text_path) > 0 AS has_text FROM kept GROUP BY 1)
    SELECT (SELECT count(*) FROM files) AS files, (SELECT count(*) FROM files WHERE sha256 IN (SELECT sha256 FROM gone)) AS excluded,
           (SELECT count(*) FROM docs) AS distinct_documents, (SELECT count(*) FROM docs WHERE has_text) AS written""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files there are, are excluded, are distinct and have a text."""
    files = _files(spark, sf_dir)
    gone = files.join(_read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id").select("sha256")
    docs = dedup.documents(dedup.without_excluded(files, gone))
    return dedup.run_summary(files, gone, docs, docs.where("text_path is not null"))


@registered("""
    SELECT doc_id, coalesce(kind, 'disclosure') AS kind, custodian FROM documents d
    LEFT JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'sfi' END AS kind, s_name AS custodian FROM supplier) s
    ON try_cast(regexp_extract(source, '[0-9]+') AS BIGINT) = s_suppkey""")
def drop_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their drop's custodian and kind, which is the default one where there is none."""
    none = F.lit(None).cast("string")
    drops = _read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("src"), F.col("s_suppkey").cast("string")).alias("drop"), F.when(F.col("s_suppkey") % 2 == 0, "sfi").alias("kind"), F.col("s_name").alias("custodian"), none.alias("agency"), none.cast("int").alias("year")
    )
    return corpus.with_drops(_documents(spark, sf_dir).withColumn("drop", F.col("source")), drops).select("doc_id", "kind", "custodian")


@registered(r"""
    SELECT page_id, replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&') AS words FROM (
        SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'),
            '(?i)</?(?:p|br|div|tr|table|thead|tbody|h[0-9]|li|ul|ol)\b[^>]*>', chr(10), 'g'), '(?i)</?(?:td|th)\b[^>]*>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS t FROM pages)""")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without their markup and with five named entities decoded."""
    return _read(spark, sf_dir, "pages").select("page_id", text.unescape_html(text.strip_tags(F.col("html"))).alias("words"))


@registered(r"""
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^[\x00\t\n\x0B\f\r ]+', ''), '[\x00\t\n\x0B\f\r ]+$', '') AS words FROM (
        SELECT doc_id, array_to_string(list_transform(string_split(regexp_replace(text, '[ \t\x{a0}]+', ' ', 'g'), chr(10)),
               lambda x: regexp_replace(regexp_replace(x, '^[\x00\t\x0B\f\r ]+', ''), '[\x00\t\x0B\f\r ]+$', '')), chr(10)) AS t
        FROM (SELECT doc_id, replace(replace(text, ' | ', '  |' || chr(9)), chr(10), ' ' || chr(10) || chr(10) || chr(10) || chr(160)) AS text FROM documents))""")
def whitespace_squeeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spaced out by rule, with white space squeezed again."""
    spaced = F.replace(F.replace("text", F.lit(" | "), F.lit("  |\t")), F.lit("\n"), F.lit(" \n\n\n "))
    return _documents(spark, sf_dir).select("doc_id", text.squeeze_whitespace(spaced).alias("words"))


def _without_tags(sql: str) -> str:
    """SQL of a text without its markup; a tag that is not closed takes the sign after it along, which is put back."""
    steps = (
        (r"(?s)<!--.*?-->", "' '"), (r"(?i)</?(?:p|br|div|tr|table|thead|tbody|h[0-9]|li|ul|ol)\b[^>]*>", "chr(10)"), (r"(?i)<(?:br|hr)\b/([^>]|$)", r"chr(10) || '\1'"), (r"(?i)<(?:br|hr)\b([^>]|$)", r"chr(10) || '\1'"),
        (r"(?i)</?(?:td|th)\b[^>]*>", "' '"), (r"<[^>]+>", "' '"),
    )
    for pattern, to in steps:
        sql = f"regexp_replace({sql}, '{pattern}', {to}, 'g')"
    return sql


def _unescaped(sql: str) -> str:
    for entity, sign in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&apos;", "chr(39)"), ("&#65;", "'A'"), ("&#x42;", "'B'"), ("&amp;", "'&'")):
        sql = f"replace({sql}, '{entity}', {sign})"
    return sql


def _plain_sql(sql: str) -> str:
    """SQL of markdown as words; paired marks are two alternatives, as there is no back reference."""
    sql = _without_tags(_unescaped(_without_tags(sql)))
    steps = (
        (r"(?m)^[ \t\n\x0B\f\r]{0,3}#+[ \t\n\x0B\f\r]+", "''"), (r"(?s)\*\*(.+?)\*\*|__(.+?)__", r"'\1\2'"), (r"\\?\*{2,}", "''"), (r"!\[[^\]]*\]\([^)]*\)", "' '"), (r"\[([^\]]*)\]\([^)]*\)", r"'\1'"),
    )
    for pattern, to in steps:
        sql = f"regexp_replace({sql}, '{pattern}', {to}, 'g')"
    lines = rf"array_to_string(list_transform(string_split(regexp_replace({sql}, '[ \t\x{{a0}}]+', ' ', 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^[\x00\t\x0B\f\r ]+', ''), '[\x00\t\x0B\f\r ]+$', '')), chr(10))"
    return rf"regexp_replace(regexp_replace(regexp_replace({lines}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\x00\t\n\x0B\f\r ]+', ''), '[\x00\t\n\x0B\f\r ]+$', '')"


_MARKED = "'## Head' || chr(10) || '**' || url || '** [link](x) ![i](y)' || chr(10) || '__a' || chr(10) || 'b__ \\** &lt;br/&gt;x&#65;&#x42; c<hr/>d e<br</td>f ' || chr(10) || ' # third' || chr(10) || html"


@registered(f"SELECT page_id, {_plain_sql('t')} AS words FROM (SELECT page_id, {_MARKED} AS t FROM pages)")
def markdown_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as markdown with embedded and escaped HTML, unclosed tags and unpaired marks, reduced to words."""
    marked = F.concat(F.lit("## Head\n**"), "url", F.lit("** [link](x) ![i](y)\n__a\nb__ \\** &lt;br/&gt;x&#65;&#x42; c<hr/>d e<br</td>f \n # third\n"), "html")
    return _read(spark, sf_dir, "pages").select("page_id", text.plain_text(marked).alias("words"))


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as filled-in forms of their source: three form lines, the last of which one of nine lacks, and then the text."""
    head = F.concat(F.lit("FORM  "), "source", F.lit("\n  Page 1 \n\n"), F.when(F.col("doc_id") % 9 != 0, "Signature:\n").otherwise(""))
    return _documents(spark, sf_dir).select("doc_id", F.col("source").alias("drop"), F.concat(head, "text").alias("fulltext"))


_LINES_SQL = r"""forms AS (
        SELECT doc_id, source AS "drop", 'FORM  ' || source || chr(10) || '  Page 1 ' || chr(10) || chr(10) || CASE WHEN doc_id % 9 <> 0 THEN 'Signature:' || chr(10) ELSE '' END || text AS fulltext FROM documents),
    keyed AS (
        SELECT doc_id, "drop", list_transform(string_split(regexp_replace(fulltext, '\n$', ''), chr(10)), lambda x: regexp_replace(regexp_replace(regexp_replace(x, '[ \t\n\f\r\x0B]+', ' ', 'g'), '^[\x00 ]+', ''), '[\x00 ]+$', '')) AS keys,
               string_split(regexp_replace(fulltext, '\n$', ''), chr(10)) AS lines
        FROM forms),
    seen AS (SELECT "drop", line, count(*) AS n_docs FROM (SELECT "drop", unnest(list_distinct(keys)) AS line FROM keyed) WHERE line <> '' GROUP BY ALL),
    common AS (SELECT "drop", line FROM seen JOIN (SELECT "drop", count(*) AS n FROM forms GROUP BY 1) USING ("drop") WHERE n >= 20 AND n_docs >= ceil(n::DOUBLE * 0.95::DOUBLE))"""


@registered(f'WITH {_LINES_SQL} SELECT "drop", line FROM common')
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are in nearly all forms of a source."""
    return boilerplate.common_lines(_forms(spark, sf_dir))


@registered(rf"""
    WITH {_LINES_SQL}, sets AS (SELECT "drop", list(line) AS common FROM common GROUP BY 1)
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(array_to_string(list_transform(list_filter(list_zip(lines, keys), lambda z: NOT coalesce(list_contains(common, z[2]), false)), lambda z: z[1]), chr(10)),
           '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\x00\t\n\x0B\f\r ]+', ''), '[\x00\t\n\x0B\f\r ]+$', '') AS fulltext
    FROM keyed LEFT JOIN sets USING ("drop")""")
def boilerplate_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms without the lines that are in nearly all forms of their source."""
    return boilerplate.strip_boilerplate(_forms(spark, sf_dir)).select("doc_id", "fulltext")


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filed documents, told by file name, stamp, month folder, or a year in the name (ten years on), in turn."""
    orders = _read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    y, turn = F.year("d"), F.col("o_orderkey") % 4
    short = F.concat(F.lit("Doc§6."), F.month("d").cast("string"), F.lit("."), F.dayofmonth("d").cast("string"), F.lit("."), F.lpad((y % 100).cast("string"), 2, "0"), F.lit(".pdf"))
    name = F.when(turn == 0, short).when(turn == 3, F.concat(F.lit("Filing_"), (y + 10).cast("string"), F.lit(".pdf"))).otherwise("Roe.pdf")
    folder = F.when(turn <= 1, y.cast("string")).when(turn == 2, F.date_format("d", "MM MMMM yyyy")).otherwise("misc")
    stamp = F.when(turn == 1, F.concat(F.lit("RECEIVED\n"), F.upper(F.date_format("d", "yyyy MMM dd")), F.lit(" AM 10:59"))).otherwise("no stamp")
    return orders.select("o_orderkey", F.array(name).alias("names"), F.concat(F.lit("drop/x/"), folder, F.lit("/"), name).alias("path"), stamp.alias("text"))


@registered("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN strftime(o_orderdate, '%Y-%m') WHEN 3 THEN (year(o_orderdate) + 10)::VARCHAR ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
           CASE o_orderkey % 4 WHEN 0 THEN 'filename' WHEN 1 THEN 'received_stamp' WHEN 2 THEN 'folder' ELSE 'filename' END AS date_source FROM orders""")
def filing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When documents were filed, by the most precise sign there is."""
    found = dates.filing(F.col("names"), F.col("path"), F.col("text"), F.lit(2026))
    return _filings(spark, sf_dir).select("o_orderkey", found.alias("f")).select("o_orderkey", "f.date", "f.date_source")


@registered("""
    SELECT o_orderkey, list_transform(list_sort(list_distinct(list_filter(CASE WHEN o_orderkey % 4 <> 0 THEN [] ELSE [
        try_cast(strftime(o_orderdate, '%Y-%m-%d') AS DATE),
        CASE WHEN day(o_orderdate) >= 10 AND month(o_orderdate) <= 31 THEN try_cast(printf('%04d-06-%02d', CASE WHEN day(o_orderdate) < 50 THEN 2000 ELSE 1900 END + day(o_orderdate), month(o_orderdate)) AS DATE) END] END,
        lambda x: x IS NOT NULL))), lambda x: strftime(x, '%Y-%m-%d')) AS days
    FROM orders""")
def date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days a file name could be read as, overlapping readings included; three of four names hold none."""
    rows = _filings(spark, sf_dir)
    return rows.select("o_orderkey", F.transform(F.array_sort(F.array_distinct(dates.candidates(text.stem(F.get("names", F.lit(0)))))), lambda d: d.cast("string")).alias("days"))


_TEMPLATES = (
    ("Seal\n**DISCLOSURE BY** EMPLOYEE OF FINANCIAL\nINTEREST (as\ndefined)", "Financial Interest"),
    ("RECEIVED\nDISCLOSURE OF TRAVEL", "Travel & Gifts"),
    ("DISCLOSURE OF APPEARANCE OF CONFLICT", "Appearance of Conflict"),
    ("DISCLOSURE UNDER RULE\nFAMILY MEMBERS FINANCIAL INTEREST", "Other"),
    ("Dear Sir, under section 23(b)(3) I disclose", "Appearance of Conflict"),
    ("a letter under sec. 13 about gifts", "Financial Interest"),
    ("Disclosure by me of travel", "Other"),
    ("see 930 CMR 5.08", "Travel & Gifts"),
)


@registered(f"SELECT o_orderkey, [{', '.join(repr(label) for _, label in _TEMPLATES)}][o_orderkey % 8 + 1] AS category FROM orders")
def category_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of texts made from eight templates, each followed by an order's remarks."""
    body = F.get(F.array(*[F.lit(t) for t, _ in _TEMPLATES]), (F.col("o_orderkey") % 8).cast("int"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", categories.category(F.concat(body, F.lit("\nOrder "), "o_orderpriority")).alias("category"))


@registered(f"""
    WITH d AS (SELECT ord, value, lower(replace(replace(value, ' & ', '-'), ' ', '-')) AS slug FROM (SELECT unnest(range(5))::INT AS ord, unnest(['Financial Interest', 'Travel & Gifts', 'Appearance of Conflict', 'Other', 'Statement of Financial Interests']) AS value)),
    c AS (SELECT [{', '.join(repr(label) for _, label in _TEMPLATES)}][o_orderkey % 8 + 1] AS value, count(*) AS n FROM orders GROUP BY 1)
    SELECT ord, value, slug, coalesce(n, 0)::BIGINT AS documents, ord IS NOT NULL AS known FROM d FULL JOIN c USING (value)""")
def category_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories in display order with the texts that are given each, and categories of texts that the list lacks."""
    return tables.category_usage(tables.categories(spark, list(categories.CATEGORIES)), category_of_text(spark, sf_dir))


@registered("""
    SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'Clerk ' || c_nationkey WHEN c_custkey % 5 <> 0 THEN 'Bare ' || c_nationkey END AS title,
           c_mktsegment AS agency FROM customer""")
def filer_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, titles and agencies from forms made of customers: labels before, in or after a line, some left blank."""
    name = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("Name of public employee:  "), "c_name", F.lit("\n"))).otherwise("")
    title = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("Title or Position:\n\nClerk "), F.col("c_nationkey").cast("string"))).otherwise(F.concat(F.lit("Title : Bare "), F.col("c_nationkey").cast("string")))
    form = F.concat(F.lit("STATE EMPLOYEE INFORMATION\n"), name, title, F.lit("\nState Agency/Department\n: "), "c_mktsegment", F.lit("\nRECEIVED"))
    return _read(spark, sf_dir, "customer").select("c_custkey", filer.filer(form).alias("f")).select("c_custkey", "f.*")


@registered("""
    SELECT p_partkey, stem || CASE WHEN n > 1 THEN '_' || n - 1 ELSE '' END || '.pdf' AS filename
    FROM (SELECT p_partkey, stem, row_number() OVER (PARTITION BY lower(stem) ORDER BY p_partkey) AS n FROM (SELECT p_partkey, replace(array_to_string(string_split(p_name, ' ')[:2], ' '), ' ', '_') AS stem FROM part))""")
def unique_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique names for parts, greedily in key order; the longer name of two is taken, and no number meets another name."""
    names = F.array(F.concat(F.initcap(F.substring_index("p_name", " ", 1)), F.lit("_1.PDF")), F.concat(F.substring_index("p_name", " ", 2), F.lit(".pdf")))
    parts = _read(spark, sf_dir, "part").select("p_partkey", text.safe_name(names).alias("s")).select("p_partkey", "s.*")
    return naming.unique_names(parts, "p_partkey", "p_partkey")


def _index(spark: SparkSession, sf_dir: str) -> search.Index:
    """The written index of documents as index records: the language as category, a partial date by doc_id, none for every eleventh."""
    year = (2000 + F.col("doc_id") % 20).cast("string")
    date = F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 2 == 0, year).otherwise(F.concat(year, F.lit("-"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0")))
    rows = _documents(spark, sf_dir).select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("filename"), F.lit(None).cast("string").alias("custodian"), F.col("lang").alias("category"), date.alias("date"), F.array(F.concat("source", F.lit(".pdf"))).alias("original_filenames"),
        F.col("text").alias("fulltext"), F.col("source").alias("name"), F.lit(None).cast("string").alias("title"), F.lit("").alias("agency"),
    )
    folder = made_once(spark, sf_dir, "index", lambda place: search.write_index(search.index_records(rows, "https://files"), place))
    return search.Index.read(spark, folder)


_INDEX_SQL = r"""docs AS (
        SELECT lpad(doc_id::VARCHAR, 12, '0') AS filename, lang, source, doc_id,
               CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN (2000 + doc_id % 20)::VARCHAR ELSE (2000 + doc_id % 20) || '-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') END AS date,
               regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words
        FROM documents)"""


@registered(rf"""
    WITH {_INDEX_SQL}, hits AS (SELECT * FROM docs WHERE list_contains(words, 'the') AND list_contains(words, 'and'))
    SELECT 'https://files/' || filename AS url FROM hits WHERE lang IN ('en') AND date[1:4] IN ('2001', '2003', '2004') ORDER BY date DESC NULLS LAST, filename LIMIT 20""")
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of a search for two words under both facets, newest first."""
    asked = SearchRequest("the AND", {"category": ("en",), "year": ("2001", "2003", "2004")}, "newest")
    return search.search(_index(spark, sf_dir), asked)[0].select("url")


@registered(rf"""
    WITH {_INDEX_SQL}, hits AS (SELECT * FROM docs WHERE contains(' ' || array_to_string(words, ' ') || ' ', ' of the '))
    SELECT 'category' AS facet, lang AS value, count(*) AS n FROM hits WHERE date[1:4] IN ('2005', '2006') GROUP BY 2
    UNION ALL SELECT 'year', date[1:4], count(*) FROM hits WHERE date IS NOT NULL AND lang IN ('en') GROUP BY 2""")
def search_phrase_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet counts of a quoted phrase, each facet under the other's selection."""
    return search.facet_counts(search.candidates(_index(spark, sf_dir), '"of the"'), {"category": ("en",), "year": ("2005", "2006")})


@registered(rf"""
    WITH {_INDEX_SQL}, t AS (SELECT unnest(['with', 'der']) AS term), n AS (SELECT count(*) AS n, avg(len(words)) AS avg_length FROM docs),
    hits AS (SELECT filename, len(words) AS length, (SELECT count(*) FROM (SELECT unnest(words) AS w) WHERE w = 'with') AS tf FROM docs WHERE list_contains(words, 'with')),
    df AS (SELECT count(*) AS df FROM hits)
    SELECT 'https://files/' || filename AS url, round(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / avg_length)), 6) AS score
    FROM hits, df, n""")
def search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 scores of all documents with a word."""
    return search.matches(_index(spark, sf_dir), "with").select("url", F.round("score", 6).alias("score"))


@registered("""
    WITH g AS (SELECT lang, source, count(*) AS n, (count(*) + 19) // 20 AS pages FROM documents GROUP BY ALL),
    p AS (SELECT *, unnest(range(1, pages + 1)) AS page FROM g),
    s AS (SELECT *, list_sort(list_distinct(list_filter([1, pages, page - 2, page - 1, page, page + 1, page + 2], lambda x: x BETWEEN 1 AND pages))) AS near FROM p)
    SELECT lang, source, page::INT AS page, (page - 1) * 20 + 1 AS first, least(n, page * 20) AS last,
           array_to_string(flatten(list_transform(range(1, len(near) + 1), lambda i: CASE WHEN i > 1 AND near[i] - near[i - 1] > 1 THEN ['…', near[i]::VARCHAR] ELSE [near[i]::VARCHAR] END)), ' ') AS links FROM s""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of the listing of each language's documents of each source: the rows they show and the pages they link; gaps in between."""
    listings = _documents(spark, sf_dir).groupBy("lang", "source").agg(F.count("*").alias("total"))
    links = F.array_join(F.transform("links", lambda n: F.coalesce(n.cast("string"), F.lit("…"))), " ")
    return search.listing_pages(listings).select("lang", "source", "page", "first", "last", links.alias("links"))


@registered(rf"""
    WITH {_INDEX_SQL}, r AS (
        SELECT 'a' AS asked, filename, row_number() OVER (ORDER BY date DESC NULLS LAST, filename) AS rank FROM docs WHERE list_contains(words, 'that') AND list_contains(words, 'with') AND lang IN ('en', 'fr')
        UNION ALL SELECT 'b', filename, row_number() OVER (ORDER BY date NULLS LAST, filename) FROM docs WHERE list_contains(words, 'und')
        UNION ALL SELECT 'c', filename, row_number() OVER (ORDER BY date DESC NULLS LAST, filename) FROM docs WHERE list_contains(words, 'los')),
    t AS (SELECT asked, count(*) AS total FROM r GROUP BY 1),
    q AS (SELECT * FROM (VALUES (1, 'a', 1, true), (2, 'a', 2, false), (3, 'b', 1, true), (4, 'a', 3, false), (5, 'c', 1, true), (6, 'b', 2, true), (7, 'a', 1, true)) v(request, asked, page, ran)),
    s AS (SELECT request, ran, asked, total, least(page, (total + 19) // 20) AS shown FROM q JOIN t USING (asked))
    SELECT request, ran, total, shown AS page, 'https://files/' || filename AS url FROM s JOIN r USING (asked) WHERE rank > 20 * (shown - 1) AND rank <= 20 * shown""")
def cached_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of seven requests in a row, with the matches of the latest two searches kept: whether each was run, its total, and the page shown."""
    a, b, c = SearchRequest("that with", {"category": ("en", "fr")}, "newest"), SearchRequest("und", {}, "oldest"), SearchRequest("los", {}, "newest")
    kept, out = search.ResultSets(_index(spark, sf_dir), 2), None
    for k, (asked, number) in enumerate([(a, 1), (a, 2), (b, 1), (a, 3), (c, 1), (b, 2), (a, 1)]):
        rows, total, page, ran = kept.page(replace(asked, page=number))
        part = rows.select(F.lit(k + 1).alias("request"), F.lit(ran).alias("ran"), F.lit(total).cast("long").alias("total"), F.lit(page).cast("long").alias("page"), "url")
        out = part if out is None else out.unionByName(part)
    kept.release()
    return out


_BM25 = "ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / avg_length))"
_TERMS_SQL = rf"""{_INDEX_SQL}, n AS (SELECT count(*) AS n, avg(len(words)) AS avg_length FROM docs),
    tf AS (SELECT filename, lang, date, len(words) AS length, term, count(*) AS tf FROM (SELECT *, unnest(words) AS term FROM docs) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""


@registered(rf"""
    WITH {_TERMS_SQL}, w AS (SELECT filename, term = 'of' AS first, sum({_BM25}) AS part FROM tf JOIN df USING (term), n WHERE term = 'of' OR starts_with(term, 'th') GROUP BY ALL)
    SELECT 'https://files/' || filename AS url, round(sum(part), 6) AS score FROM w GROUP BY filename HAVING count(*) = 2""")
def search_begun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 scores of a search whose last word is still being typed: all words that begin so answer for it."""
    return search.matches(_index(spark, sf_dir), "OF th", begun=True).select("url", F.round("score", 6).alias("score"))


@registered(rf"""
    WITH {_TERMS_SQL}, w AS (SELECT filename, round(sum({_BM25}), 9) AS score FROM tf JOIN df USING (term), n WHERE term IN ('the', 'and') AND lang IN ('en') GROUP BY filename HAVING count(*) = 2)
    SELECT 'https://files/' || filename AS url, filename, round(score, 6) AS score FROM (SELECT *, row_number() OVER (ORDER BY score DESC, filename) AS place FROM w) WHERE place <= 20""")
def search_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page by relevance under a facet, found by blocks of largest parts."""
    best = search.best_matches(_index(spark, sf_dir), "the and", 20, {"category": ("en",)})
    return spark.createDataFrame([(r.url, r.filename, r.score) for r in best.rows], "url string, filename string, score double").withColumn("score", F.round("score", 6))


@registered(rf"WITH {_INDEX_SQL} SELECT w AS term, count(DISTINCT filename) AS df, count(*) AS cf FROM (SELECT filename, unnest(words) AS w FROM docs) GROUP BY 1")
def index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document and collection frequencies of the index's terms."""
    return _index(spark, sf_dir).terms.select("term", "df", "cf")


@registered(rf"""
    WITH {_INDEX_SQL}, m AS (SELECT ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'] AS names)
    SELECT 'https://files/' || filename AS url, source || '.pdf' AS title,
           array_to_string(list_filter([CASE WHEN len(date) = 7 THEN names[date[6:7]::INT] || ' ' || date[1:4] ELSE date END, source, lang], lambda x: x IS NOT NULL), ' · ') AS details
    FROM docs, m""")
def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and detail line of each record."""
    return _index(spark, sf_dir).entries.select("url", search.shown_title().alias("title"), search.details().alias("details"))


@registered("SELECT DISTINCT year(o_orderdate)::VARCHAR AS year FROM orders ORDER BY 1 DESC")
def year_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years that documents have, newest first."""
    return rollup.years(_read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("date")))


@registered("SELECT o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY 1")
def kind_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.tally(_read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind")), "kind")


@registered("""
    SELECT count(*) FILTER (o_orderstatus <> 'F') AS disclosure_count, count(*) FILTER (o_orderstatus = 'F') AS statement_count,
           list_reverse_sort(list_distinct(list(year(o_orderdate)::VARCHAR))) AS years FROM orders""")
def site_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one category and of all others, and their years."""
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("category"), F.col("o_orderdate").cast("date").cast("string").alias("date"))
    return rollup.site_counts(rows, "F")


@registered("""
    SELECT o_orderkey, strftime(o_orderdate, '%b ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') AS shown,
           CASE WHEN o_orderkey % 3 = 0 THEN 'https://x/' || o_orderkey ELSE 'https://files/drops/' || o_orderkey || '.zip' END AS href
    FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC""")
def drops_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops with their day and address, newest first."""
    key = F.col("o_orderkey").cast("string")
    own = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("https://x/"), key)).otherwise("")
    none = F.lit(None).cast("string")
    drops = _read(spark, sf_dir, "orders").select(F.concat(key, F.lit(".zip")).alias("filename"), F.col("o_orderdate").cast("date").alias("date"), none.alias("custodian"), none.alias("notes"), own.alias("url"))
    rows = publish.drop_table(drops, "https://files/drops")
    return rows.select(F.regexp_extract("filename", r"^(\d+)", 1).cast("long").alias("o_orderkey"), F.col("received").alias("shown"), "href")


_PORTAL_SQL = """items AS (
        SELECT event_id, ts, CASE event_id % 3
            WHEN 0 THEN strftime(ts, '%Y') || '/' || strftime(ts, '%Y-%m-%d') || ' User ' || user_id % 50 || '.pdf'
            WHEN 1 THEN strftime(ts, '%Y') || '/' || strftime(ts, '%Y-%m-%d') || ' A B U' || user_id % 50 || '.pdf'
            ELSE 'undated/' || event_type || '.pdf' END AS path FROM events)"""


@registered(f"WITH {_PORTAL_SQL} SELECT event_id, CASE WHEN n = 1 THEN path ELSE path[:-5] || ' (' || n || ').pdf' END AS unique_path FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY event_id) AS n FROM items)")
def occurrence_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where portal items are filed by their titles, repeats numbered in order of arrival."""
    who = (F.col("user_id") % 50).cast("string")
    slashed = F.concat(F.lit("Form "), F.date_format("ts", "yyyy/MM/dd"), F.lit(" -  User "), who)
    compact = F.concat(F.lit("Form – "), F.date_format("ts", "yyyyMMdd"), F.lit("-U"), who, F.lit("-A-B"))
    title = F.when(F.col("event_id") % 3 == 0, slashed).when(F.col("event_id") % 3 == 1, compact).otherwise("Form")
    items = _read(spark, sf_dir, "events").select("event_id", display.portal_path(title, F.concat("event_type", F.lit(".pdf"))).alias("path"))
    return rollup.numbered_paths(items, "path", "event_id").select("event_id", "unique_path")


def _page_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as recognised documents: a turn is a page, every 41st page is an error."""
    return _read(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc"), F.col("turn").cast("int").alias("page_num"), F.col("text").alias("markdown"), F.concat(F.lit("<p>"), "role", F.lit("</p>")).alias("html"),
        F.length("text").alias("token_count"), F.lit(1).alias("num_chunks"), F.lit(0).alias("num_images"), ((F.col("conv_id") * 7 + F.col("turn")) % 41 == 0).alias("error"),
    )


@registered("""
    SELECT conv_id AS doc, count(*) AS num_pages, sum(length(text))::BIGINT AS total_token_count, string_agg(coalesce(text, ''), '' ORDER BY turn, text) AS markdown,
           string_agg('<p>' || role || '</p>', '' ORDER BY turn, '<p>' || role || '</p>') AS html, bool_or((conv_id * 7 + turn) % 41 = 0) AS failed
    FROM conversations GROUP BY 1""")
def page_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents from their pages: totals, text in page order, and whether a page failed."""
    return rollup.page_rollup(_page_results(spark, sf_dir)).select("doc", "num_pages", "total_token_count", "markdown", "html", "failed")


@registered("""
    SELECT conv_id AS doc, count(*) AS num_pages FROM conversations GROUP BY 1 HAVING count(*) = max(turn) - min(turn) + 1 AND NOT bool_or((conv_id * 7 + turn) % 41 = 0)""")
def complete_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have all of their pages, none of them failed."""
    pages = _page_results(spark, sf_dir)
    expected = pages.groupBy("doc").agg((F.max("page_num") - F.min("page_num") + 1).alias("expected_pages"))
    return rollup.complete_documents(rollup.page_rollup(pages), expected).select("doc", "num_pages")


@registered("""
    WITH p AS (SELECT conv_id, turn, conv_id // 16 AS part, (conv_id * 7 + turn) % 41 = 0 AS error, text FROM conversations),
    b AS (SELECT *, (row_number() OVER (PARTITION BY part ORDER BY conv_id, turn, text) - 1) // 8 AS batch FROM p)
    SELECT conv_id AS doc, turn::INT AS page_num, batch, max(error) OVER (PARTITION BY part, batch) AS error FROM b""")
def batch_poisoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in inference batches of eight across documents; a page's error is its whole batch's."""
    pages = _page_results(spark, sf_dir).withColumn("part", F.floor(F.col("doc") / 16))  # as many parts as the documents need
    return rollup.poison_batches(rollup.batched(pages, ["doc", "page_num", "markdown"], 8)).select("doc", "page_num", "batch", "error")


@registered("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id LIMIT 100")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred documents, in order, that have no label yet."""
    return syncplan.pending(_documents(spark, sf_dir).select("doc_id"), _read(spark, sf_dir, "labels"), "doc_id", 100)


@registered("""
    SELECT coalesce(l.name, r.name) AS name, CASE WHEN l.name IS NULL THEN 'delete' WHEN l.size = r.size THEN 'keep' ELSE 'copy' END AS action
    FROM (SELECT 'f' || doc_id AS name, n_chars AS size FROM documents WHERE doc_id % 5 <> 0) l
    FULL JOIN (SELECT 'f' || doc_id AS name, CASE WHEN doc_id % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS size FROM documents WHERE doc_id % 3 <> 0) r ON l.name = r.name""")
def bucket_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mirror by size has to copy, keep and delete."""
    docs = _documents(spark, sf_dir).select(F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("name"), F.col("n_chars").alias("size"), "doc_id")
    remote = docs.where("doc_id % 3 <> 0").select("name", F.when(F.col("doc_id") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"))
    return syncplan.bucket_plan(docs.where("doc_id % 5 <> 0").select("name", "size"), remote, 1)


@registered("""
    SELECT coalesce(w.name, e.name) AS name, coalesce(w.target, e.target) AS target,
           CASE WHEN w.name IS NULL THEN 'remove' WHEN w.target = e.target THEN 'keep' ELSE 'link' END AS action
    FROM (SELECT 'f' || doc_id AS name, 's' || doc_id AS target FROM documents WHERE doc_id % 5 <> 0) w
    FULL JOIN (SELECT 'f' || doc_id AS name, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE 's' || doc_id END AS target FROM documents WHERE doc_id % 3 <> 0) e ON w.name = e.name""")
def mirror_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mirror of links has to link, keep and remove."""
    key = F.col("doc_id").cast("string")
    docs = _documents(spark, sf_dir).select("doc_id", F.concat(F.lit("f"), key).alias("name"), F.concat(F.lit("s"), key).alias("target"))
    existing = docs.where("doc_id % 3 <> 0").select("name", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("target")).alias("target"))
    return syncplan.mirror_plan(docs.where("doc_id % 5 <> 0"), existing)


@registered("""
    SELECT coalesce(m.filename, f.filename) AS filename, CASE WHEN f.filename IS NULL THEN 'missing' WHEN m.filename IS NULL THEN 'unlisted' WHEN m.sha256 = f.sha256 THEN 'ok' ELSE 'mismatch' END AS status
    FROM (SELECT 'f' || doc_id AS filename, CASE WHEN doc_id % 10 = 1 THEN sha256('x') ELSE sha256(text) END AS sha256 FROM documents WHERE doc_id % 6 <> 0) m
    FULL JOIN (SELECT 'f' || doc_id AS filename, sha256(text) AS sha256 FROM documents WHERE doc_id % 4 <> 0) f ON m.filename = f.filename""")
def checksum_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files against a checksum manifest."""
    docs = _documents(spark, sf_dir).select("doc_id", F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("filename"), F.sha2("text", 256).alias("sha256"))
    listed = docs.where("doc_id % 6 <> 0").select("filename", F.when(F.col("doc_id") % 10 == 1, F.sha2(F.lit("x"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    return syncplan.checksum_report(docs.where("doc_id % 4 <> 0"), listed)


@registered("SELECT c_custkey, format('{:,}', c_custkey * 1237) AS shown, lower(replace(c_mktsegment, ' ', '-')) || '-' || c_nationkey AS slug FROM customer")
def display_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers grouped by thousands, and slugs."""
    slug: Column = display.slugify(F.concat(F.lit(" "), "c_mktsegment", F.lit(" & "), F.col("c_nationkey").cast("string"), F.lit("!")))
    return _read(spark, sf_dir, "customer").select("c_custkey", display.delimit(F.col("c_custkey") * 1237).alias("shown"), slug.alias("slug"))


from docketry.plans import flow_queries  # noqa: E402, F401 (registers further queries)

__all__ = ["ORACLE_SQL", "QUERIES"]
