"""Registered queries of sources, sinks and whole flows, over files that are made from the tables.

The tables hold no files, so documents are written as PDFs and texts below the shared folder first (their bytes are their text), by a rule that
the SQL follows; then they are scanned, ingested and built into a corpus by the library's own functions.
"""

from __future__ import annotations

import datetime
import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import category as categories
from docketry.functions import dates, filer, text
from docketry.operators import naming, rollup, search, syncplan
from docketry.operators.durable import checkpointed
from docketry.plans import corpus, ingest, pages, publish, request
from docketry.plans.registered import fresh, made_once, read, registered
from docketry.sources import archives, files, portal, tables, trees, writers
from docketry.streaming import incremental

AS_OF = datetime.date(2026, 6, 1)
_EDGE = r"[\x00\t\n\x0B\f\r ]+"


def _key(column: str = "doc_id") -> Column:
    return F.col(column).cast("string")


# Documents as files: a drop by source, a year, the id, and a name that many share; some names begin with "_", some extensions are upper-case, some
# files are empty. Two of three have a text, some as markdown (which is made of their language and source), some in both forms.
def _drop() -> Column:
    return F.concat(F.lit("2025-01-15-"), "source")


def _name() -> Column:
    mark = F.when(F.col("doc_id") % 31 == 0, "_").otherwise("")
    return F.concat(mark, F.lit("d"), (F.col("doc_id") % 7).cast("string"), F.when(F.col("doc_id") % 13 == 0, ".PDF").otherwise(".pdf"))


def _place() -> Column:
    return F.concat(_drop(), F.lit("/"), (2000 + F.col("doc_id") % 20).cast("string"), F.lit("/x"), _key(), F.lit("/"), _name())


_FILES = r"""f AS (
        SELECT doc_id, lang, source, '2025-01-15-' || source AS "drop", CASE WHEN doc_id % 31 = 0 THEN '_' ELSE '' END || 'd' || doc_id % 7 || CASE WHEN doc_id % 13 = 0 THEN '.PDF' ELSE '.pdf' END AS name,
               CASE WHEN doc_id % 50 = 49 THEN '' ELSE text END AS content, text FROM documents),
    files AS (SELECT *, "drop" || '/' || 2000 + doc_id % 20 || '/x' || doc_id || '/' || name AS path, sha256(content) AS sha256 FROM f),
    texts AS (
        SELECT doc_id, path, path[:-5] || '/' || name[:-5] || CASE WHEN doc_id % 5 = 0 THEN '.md' ELSE '.txt' END AS text_path,
               CASE WHEN doc_id % 5 = 0 THEN 'md' ELSE 'txt' END AS ext FROM files WHERE doc_id % 3 <> 0)"""
_FORM = "FORM  OF\n\n\n\nINTERESTS\t \n"


def _text() -> Column:
    """A plain text: a form's lines in drops of statements, else a title, fields, a stamp or nothing before the document's own text."""
    own = F.col("doc_id") % 4
    head = F.when(own == 1, "DISCLOSURE OF GIFT\n").when(own == 2, F.concat(F.lit("Name of public employee:\n P "), _key(), F.lit("\nTitle: Clerk\n")))
    head = head.when(own == 3, F.concat((2000 + F.col("doc_id") % 20).cast("string"), F.lit(" AUG 23 AM 1:00\n"))).otherwise("")
    return F.concat(F.when(F.regexp_extract("source", "([0-9]+)", 1).cast("int") % 2 == 0, _FORM).otherwise(head), "text")


def _pdf_tree(spark: SparkSession, sf_dir: str) -> str:
    rows = read(spark, sf_dir, "documents").select(_place().alias("path"), F.when(F.col("doc_id") % 50 == 49, "").otherwise(F.col("text")).cast("binary").alias("content"))
    return made_once(spark, sf_dir, "pdfs", lambda folder: writers.write_files(rows, folder))


def _text_tree(spark: SparkSession, sf_dir: str) -> str:
    docs = read(spark, sf_dir, "documents").where("doc_id % 3 <> 0").withColumn("name", _name()).withColumn("path", _place())
    base = F.concat(F.regexp_replace("path", r"\.[^.]*$", ""), F.lit("/"), F.regexp_replace("name", r"\.[^.]*$", ""))
    marked = F.concat(F.lit("# Head\n**"), "lang", F.lit("** ["), "source", F.lit("](x)"))
    as_md = docs.where("doc_id % 5 = 0").select(F.concat(base, F.lit(".md")).alias("path"), marked.cast("binary").alias("content"))
    as_txt = docs.where("doc_id % 5 <> 0 or doc_id % 10 = 0").select(F.concat(base, F.lit(".txt")).alias("path"), _text().cast("binary").alias("content"))
    return made_once(spark, sf_dir, "texts", lambda folder: writers.write_files(as_md.unionByName(as_txt), folder))


def _drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop metadata of the sources: statements where the number is even, an agency for every third, none at all for every seventh."""
    sources = [r.source for r in read(spark, sf_dir, "documents").select("source").distinct().orderBy("source").collect()]  # a row for each drop
    entries = {}
    for name in sources:
        n = int(name.removeprefix("src"))
        if n % 7 != 6:
            entries[f"2025-01-15-{name}.zip"] = {"custodian": f"C{n}"} | ({"kind": "sfi", "year": 2020 + n % 5} if n % 2 == 0 else {}) | ({"agency": f"A{n}"} if n % 3 == 0 else {})
    return tables.drop_metadata(spark, entries)


@registered(f"WITH {_FILES} SELECT path, sha256 FROM files")
def pdf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All PDFs below drops: names that begin with ``_``, upper-case extensions and empty files too."""
    return files.scan_pdfs(spark, _pdf_tree(spark, sf_dir))


def _squeezed(sql: str) -> str:
    """SQL of a text with white space squeezed."""
    lines = rf"array_to_string(list_transform(string_split(regexp_replace({sql}, '[ \t\x{{a0}}]+', ' ', 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^[\x00\t\x0B\f\r ]+', ''), '[\x00\t\x0B\f\r ]+$', '')), chr(10))"
    return rf"regexp_replace(regexp_replace(regexp_replace({lines}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_EDGE}', ''), '{_EDGE}$', '')"


_RAW = rf"""CASE WHEN regexp_extract(source, '[0-9]+')::INT % 2 = 0 THEN 'FORM  OF' || repeat(chr(10), 4) || 'INTERESTS' || chr(9) || ' ' || chr(10)
        ELSE CASE doc_id % 4 WHEN 1 THEN 'DISCLOSURE OF GIFT' || chr(10) WHEN 2 THEN 'Name of public employee:' || chr(10) || ' P ' || doc_id || chr(10) || 'Title: Clerk' || chr(10)
             WHEN 3 THEN 2000 + doc_id % 20 || ' AUG 23 AM 1:00' || chr(10) ELSE '' END END || text"""
_WORDS = f"CASE WHEN ext = 'md' THEN 'Head' || chr(10) || lang || ' ' || source ELSE {_squeezed(_RAW)} END"


@registered(f"""WITH {_FILES} SELECT text_path, ext, {_WORDS} AS words FROM texts JOIN files USING (doc_id)
    UNION ALL SELECT path[:-5] || '/' || name[:-5] || '.txt', 'txt', {_squeezed(_RAW)} FROM files WHERE doc_id % 10 = 0 AND doc_id % 3 <> 0""")
def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All extracted texts, markdown reduced to words and others with their white space squeezed."""
    found = files.scan_texts(spark, _text_tree(spark, sf_dir))
    return found.select("text_path", "ext", text.fulltext(F.col("text"), F.col("ext")).alias("words"))


@registered(f"WITH {_FILES} SELECT files.path, text_path FROM files LEFT JOIN texts USING (doc_id)")
def text_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each PDF's text: markdown if there is any, else plain text, else none."""
    found = files.with_text_paths(files.scan_pdfs(spark, _pdf_tree(spark, sf_dir)), files.scan_texts(spark, _text_tree(spark, sf_dir)))
    return found.select("path", "text_path")


_CORPUS = rf"""{_FILES},
    gone AS (SELECT DISTINCT sha256 FROM files JOIN labels USING (doc_id) WHERE toxic = 1),
    kept AS (SELECT files.*, text_path, ext FROM files LEFT JOIN texts USING (doc_id) WHERE sha256 NOT IN (SELECT sha256 FROM gone)),
    named AS (SELECT sha256, name, min(path) AS first FROM kept GROUP BY ALL),
    docs AS (
        SELECT k.sha256, min(k.path) AS first_path, (SELECT list(name ORDER BY first) FROM named n WHERE n.sha256 = k.sha256) AS names,
               arg_min(k.doc_id, k.path) FILTER (k.text_path IS NOT NULL) AS doc_id FROM kept k GROUP BY k.sha256),
    safe AS (
        SELECT *, list_filter(names, lambda x: len(x) = list_max(list_transform(names, lambda y: len(y))))[1] AS long FROM docs),
    stems AS (SELECT *, ltrim(long[:-5], '_') AS stem, lower(long[-4:]) AS e FROM safe),
    numbers AS (SELECT *, row_number() OVER (PARTITION BY lower(stem), e ORDER BY first_path, sha256) AS n FROM stems),
    whole AS (
        SELECT stem || CASE WHEN n > 1 THEN '_' || n - 1 ELSE '' END || e AS filename, names, k.path, k.sha256, k.doc_id, k.lang, k.source, k."drop", regexp_extract(k.source, '[0-9]+')::INT AS s, {_WORDS} AS words
        FROM numbers JOIN kept k USING (doc_id)),
    own AS (
        SELECT *, s % 7 <> 6 AND s % 2 = 0 AS sfi, list_transform(string_split(words, chr(10)), lambda x: trim(regexp_replace(x, '[ \t\n\f\r\x0B]+', ' ', 'g'))) AS keys FROM whole),
    seen AS (SELECT "drop", line, count(*) AS n FROM (SELECT "drop", unnest(list_distinct(keys)) AS line FROM own WHERE sfi) WHERE line <> '' GROUP BY ALL),
    common AS (SELECT "drop", list(line) AS lines FROM seen JOIN (SELECT "drop", count(*) AS total FROM own WHERE sfi GROUP BY 1) USING ("drop") WHERE total >= 20 AND n >= ceil(total::DOUBLE * 0.95::DOUBLE) GROUP BY 1),
    out AS (
        SELECT *, array_to_string(list_transform(list_filter(list_zip(string_split(words, chr(10)), keys), lambda z: NOT coalesce(list_contains(lines, z[2]), false)), lambda z: z[1]), chr(10)) AS left_over,
               words LIKE 'DISCLOSURE OF GIFT%' AS titled, words LIKE 'Name of public employee:%' AS filed, regexp_matches(words, '^20[0-9][0-9] AUG 23 AM') AS stamped
        FROM own LEFT JOIN common USING ("drop"))
    SELECT filename, CASE WHEN s % 7 <> 6 THEN 'C' || s END AS custodian, CASE WHEN sfi THEN 'Statement of Financial Interests' WHEN titled THEN 'Travel & Gifts' ELSE 'Other' END AS category,
           CASE WHEN sfi THEN (2020 + s % 5)::VARCHAR WHEN stamped THEN 2000 + doc_id % 20 || '-08-23' ELSE (2000 + doc_id % 20)::VARCHAR END AS date,
           CASE WHEN sfi THEN 'drop' WHEN stamped THEN 'received_stamp' ELSE 'folder' END AS date_source, names AS original_filenames, path AS original_path, sha256 AS sha256sum,
           CASE WHEN sfi THEN regexp_replace(regexp_replace(regexp_replace(left_over, '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_EDGE}', ''), '{_EDGE}$', '') ELSE words END AS fulltext,
           CASE WHEN filed AND NOT sfi THEN 'P ' || doc_id END AS name, CASE WHEN filed AND NOT sfi THEN 'Clerk' END AS title, CASE WHEN s % 3 = 0 AND s % 7 <> 6 THEN 'A' || s END AS agency
    FROM out"""


@registered(f"WITH {_CORPUS}")
def corpus_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus of all files: excluded, deduplicated, named, with texts, categories, dates and filers; written as JSON lines and read again."""
    pdfs, texts, drops = files.scan_pdfs(spark, _pdf_tree(spark, sf_dir)), files.scan_texts(spark, _text_tree(spark, sf_dir)), _drops(spark, sf_dir)
    toxic = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id")
    gone = toxic.select(F.sha2(F.when(F.col("doc_id") % 50 == 49, "").otherwise(F.col("text")), 256).alias("sha256"))
    built = corpus.build_corpus(pdfs, texts, drops, gone, AS_OF)
    with fresh(spark, "corpus") as folder:
        tables.write_corpus(built, folder)
        return checkpointed(tables.read_corpus(spark, folder))


@registered("""
    SELECT doc_id, p[3:] AS relative, string_split(p, '/')[-1] AS name, 'drop ' || source AS "drop", CASE WHEN doc_id % 3 = 0 THEN '.x' || lang ELSE source || CASE WHEN doc_id % 3 = 1 THEN '.tar' ELSE '' END END AS stem,
           CASE doc_id % 3 WHEN 1 THEN '.' || lang WHEN 2 THEN '' ELSE '' END AS extension
    FROM (SELECT *, '/r/drop ' || source || '/' || doc_id || '/' || CASE doc_id % 3 WHEN 0 THEN '.x' || lang WHEN 1 THEN source || '.tar.' || lang ELSE source END AS p FROM documents)""".replace("p[3:] AS relative", "p[4:] AS relative"))
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths below a root, their drops, base names, stems and last extensions."""
    turn = F.col("doc_id") % 3
    last = F.when(turn == 0, F.concat(F.lit(".x"), "lang")).when(turn == 1, F.concat("source", F.lit(".tar."), "lang")).otherwise(F.col("source"))
    path = F.concat(F.lit("/r/drop "), "source", F.lit("/"), _key(), F.lit("/"), last)
    rows = read(spark, sf_dir, "documents").select("doc_id", text.relative_path(path, "/r/").alias("relative"))
    rows = rows.withColumn("name", text.basename(F.col("relative")))
    return rows.select("doc_id", "relative", "name", text.drop_of(F.col("relative")).alias("drop"), text.stem(F.col("name")).alias("stem"), text.extension(F.col("name")).alias("extension"))


@registered(r"""
    WITH n AS (SELECT doc_id, list_concat([source || '.Pdf'], list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: replace(x, '/', '-') || ' Ünï' || CASE WHEN doc_id % 2 = 0 THEN '.PDF' ELSE '' END)) AS names FROM documents),
    m AS (SELECT doc_id, names, list_max(list_transform(names, lambda y: length(y))) AS most FROM n),
    l AS (SELECT doc_id, list_filter(names, lambda x: length(x) = most)[1] AS name FROM m),
    p AS (SELECT doc_id, regexp_extract(name, '(?s)^.+?(\.[^.]+)$', 1) AS ext, name FROM l),
    s AS (SELECT doc_id, ext, CASE WHEN position('.' IN name[2:]) = 0 THEN name ELSE regexp_extract(name, '(?s)^(.+)\.[^.]*$', 1) END AS stem FROM p),
    c AS (SELECT doc_id, lower(ext) AS ext, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(strip_accents(stem), '[ \t\n\x0B\f\r.]+', '_', 'g'), '[^A-Za-z0-9_-]', '', 'g'), '_{2,}', '_', 'g'), '^[_-]+', ''), '_$', '') AS stem FROM s)
    SELECT doc_id, CASE WHEN stem = '' THEN 'document' ELSE stem END AS stem, ext FROM c""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest of each document's names, which are its source and all lines of its text, reduced to safe signs."""
    end = F.concat(F.lit(" Ünï"), F.when(F.col("doc_id") % 2 == 0, ".PDF").otherwise(""))
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.concat(F.replace(x, F.lit("/"), F.lit("-")), end))
    return read(spark, sf_dir, "documents").select("doc_id", text.safe_name(F.concat(F.array(F.concat("source", F.lit(".Pdf"))), lines)).alias("s")).select("doc_id", "s.*")


# Names and folders of twelve kinds; the day is the order's own, the clock stands at 2026.
_KINDS = 12


@registered("""
    WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, year(o_orderdate) AS y, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey % 12 AS kind FROM orders)
    SELECT o_orderkey, CASE kind
        WHEN 0 THEN iso WHEN 1 THEN iso WHEN 2 THEN y + 8 || '-06' WHEN 3 THEN y + 8 || strftime(d, '-%m') WHEN 4 THEN iso WHEN 5 THEN strftime(d + 3, '%Y-%m-%d') WHEN 6 THEN (y + 1)::VARCHAR
        WHEN 7 THEN y + 8 || '-09' WHEN 8 THEN NULL WHEN 9 THEN iso WHEN 10 THEN '1995-01-02' ELSE y || '-03' END AS date,
        CASE kind WHEN 6 THEN 'folder' WHEN 8 THEN NULL WHEN 9 THEN 'received_stamp' WHEN 11 THEN 'folder' ELSE 'filename' END AS date_source
    FROM o""")
def filing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing days of twelve kinds of names, folders and stamps: ISO days with either sign, named months in any case, the reading that is nearest the stamp, folder years that are hard, folder months that are not."""
    d = F.col("o_orderdate").cast("date")
    y, kind = F.year(d), F.col("o_orderkey") % _KINDS
    iso, later = d.cast("string"), (y + 8).cast("string")
    us = lambda day: F.concat(F.month(day).cast("string"), F.lit("-"), F.dayofmonth(day).cast("string"), F.lit("-"), F.year(day).cast("string"))
    year = lambda n: F.concat(F.lit("d/x/"), n.cast("string"), F.lit("/n.pdf"))
    names = {
        0: F.array(F.concat(F.lit("Roe "), iso, F.lit(".pdf"))), 1: F.array(F.lit("x.pdf"), F.concat(F.lit("a ("), F.replace(iso, F.lit("-"), F.lit(".")), F.lit(").pdf"))),
        2: F.array(F.concat(later, F.lit("_JUNE_Ireland.pdf"))), 3: F.array(F.concat(F.lit("trip "), later, F.lit(", "), F.date_format(d, "MMM"), F.lit(".pdf"))),
        4: F.array(F.concat(F.lit("a "), us(d), F.lit(".pdf")), F.concat(F.lit("b "), us(F.date_add(d, 3)), F.lit(".pdf"))),
        5: F.array(F.concat(F.lit("a "), us(d), F.lit(".pdf")), F.concat(F.lit("b "), us(F.date_add(d, 3)), F.lit(".pdf"))),
        6: F.array(F.concat(F.lit("a "), us(d), F.lit(".pdf"))), 7: F.array(F.concat(later, F.lit(" sept.pdf"))), 8: F.array(F.lit("20-12-2814 2099.pdf")), 9: F.array(F.lit("Roe.pdf")),
        10: F.array(F.lit("1.2.95.pdf")), 11: F.array(F.lit("Roe.pdf")),
    }
    stamp = lambda day: F.concat(F.date_format(day, "yyyy"), F.lit(" "), F.upper(F.date_format(day, "MMM")), F.lit(" "), F.dayofmonth(day).cast("string"), F.lit(" PM 1:00"))
    paths = {6: year(y + 1), 11: F.concat(F.lit("d/"), F.lit("Maryann "), y.cast("string"), F.lit(".pdf"))}
    texts = {4: F.lit("no stamp"), 5: stamp(F.date_add(d, 3)), 9: F.concat(F.lit("RECEIVED\n"), stamp(d), F.lit("\n2001 JAN 1 AM 2:00"))}

    def chosen(values: dict[int, Column], other: Column) -> Column:
        out = other
        for k, value in values.items():
            out = F.when(kind == k, value).otherwise(out)
        return out

    found = dates.filing(chosen(names, F.array(F.lit("n.pdf"))), chosen(paths, F.lit("d/n.pdf")), chosen(texts, F.lit("")), F.lit(AS_OF.year))
    return read(spark, sf_dir, "orders").select("o_orderkey", found.alias("f")).select("o_orderkey", "f.date", "f.date_source")


@registered("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%b ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') WHEN 1 THEN strftime(o_orderdate, '%b %Y') WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE '' END AS shown
    FROM orders""")
def display_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days, months, years and no date at all as readers see them."""
    d, kind = F.col("o_orderdate").cast("date").cast("string"), F.col("o_orderkey") % 4
    partial = F.when(kind == 0, d).when(kind == 1, F.substring(d, 1, 7)).when(kind == 2, F.substring(d, 1, 4))
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.display_date(partial).alias("shown"))


@registered("""
    SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN 'Jane Redacted ' || c_name WHEN 1 THEN 'Jane ' || c_name WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE c_name END AS name,
           CASE WHEN c_custkey % 10 = 7 THEN NULL WHEN c_custkey % 10 = 8 THEN 'Office' ELSE c_mktsegment END AS title, CASE WHEN c_custkey % 10 = 9 THEN 'Parks' END AS agency
    FROM customer""".replace("WHEN c_custkey % 10 = 8 THEN 'Office'", "WHEN c_custkey % 10 = 8 THEN 'Officer'"))
def filer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with marks of blanks in place of values, redactions in either case, instructions, and labels too far from the name."""
    kind = F.col("c_custkey") % 10
    value = F.when(kind == 0, F.concat(F.lit("Jane Redacted "), "c_name")).when(kind == 1, F.concat(F.lit("Jane [REDACTED] "), "c_name")).when(kind == 2, "____ .")
    value = value.when(kind == 3, "12 AUG 2020").when(kind == 4, "STATE EMPLOYER INFORMATION").when(kind == 5, "fill in here").when(kind == 6, "NAME:").otherwise(F.col("c_name"))
    title = F.when(kind == 7, "Title:\nAgency Address").when(kind == 8, "TITLE/POSITION : Officer").otherwise(F.concat(F.lit("Public Official Position [insert title]: "), "c_mktsegment"))
    agency = F.when(kind == 9, "\nagency:\nParks").otherwise("\n1\n2\n3\n4\n5\n6\nDepartment: too far")
    form = F.concat(F.lit("Name of Appointing Authority: no\nNAME of Municipal Employee: "), value, F.lit("\n"), title, agency)
    return read(spark, sf_dir, "customer").select("c_custkey", filer.filer(form).alias("f")).select("c_custkey", "f.*")


_EDGE_TEMPLATES = (
    ("disclosure of Travel\nDISCLOSURE OF [redacted] TRAVEL", "Travel & Gifts"),
    ("RECONCILIATION STATEMENT\nof nothing", "Travel & Gifts"),
    ("DISCLOSURE BY (of a\nGIFT) ME\nUNCOMPENSATED POSITION", "Other"),
    ("12 MAR 3 AM 10:22\nDISCLOSURE OF\n\n  APPEARANCE OF CONFLICT", "Appearance of Conflict"),
    ("DISCLOSURES OF GIFT\nsee § 6B", "Other"),
    ("SEC. 6 and s. 23 B 3", "Financial Interest"),
    ("930 cmr 6.25", "Financial Interest"),
    ("930 CMR 6.24 and an HONORARIUM", "Travel & Gifts"),
    ("sections 23(b)(3)", "Appearance of Conflict"),
    ("section 71, s.20", "Financial Interest"),
)


@registered(f"SELECT o_orderkey, [{', '.join(repr(label) for _, label in _EDGE_TEMPLATES)}][o_orderkey % 10 + 1] AS category FROM orders")
def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of adversarial texts: mixed case, noise inside titles, citations in their order of priority."""
    body = F.get(F.array(*[F.lit(t) for t, _ in _EDGE_TEMPLATES]), (F.col("o_orderkey") % 10).cast("int"))
    return read(spark, sf_dir, "orders").select("o_orderkey", categories.category(F.concat(body, F.lit("\nOrder "), "o_orderpriority")).alias("category"))


@registered("SELECT count(*) FILTER (c_custkey % 3 <> 1) AS disclosure_count, count(*) FILTER (c_custkey % 3 = 1) AS statement_count, ['2021', '2020'] AS years FROM customer")
def site_counts_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published counts where a third of the documents have no category; those are disclosures."""
    kind, label = F.col("c_custkey") % 3, categories.STATEMENT
    rows = read(spark, sf_dir, "customer").select(F.when(kind == 1, label).when(kind == 2, "Other").alias("category"), F.when(kind == 1, "2021-02").when(kind == 2, "2020").alias("date"))
    return publish.site_data(rows)


@registered("""
    SELECT doc_id, CASE WHEN len(pages) > 0 AND len(list_filter(pages, lambda p: length(regexp_replace(p, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) < 10)) = 0 THEN array_to_string(pages, chr(10)) END AS text
    FROM (SELECT doc_id, string_split(replace(text, chr(10), chr(12)), chr(12))[:-2] AS pages FROM documents)""".replace("\\\\", "\\"))
def text_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text layers by an external tool (here one that prints the file), of the documents of which every page has text."""
    found = read(spark, sf_dir, "documents").select(_key().alias("path"), F.replace("text", F.lit("\n"), F.lit("\f")).cast("binary").alias("content"))
    return files.text_layers(found, ("sh", "-c", 'cat "$1"', "sh")).select(F.col("path").cast("long").alias("doc_id"), "text")


def _zips(spark: SparkSession, sf_dir: str) -> str:
    """A zip for each nation, with a file for each other nation of its region."""
    nations = read(spark, sf_dir, "nation")
    inner = nations.select(F.col("n_regionkey").alias("r"), F.col("n_name").alias("inner"))
    rows = nations.join(inner, F.col("n_regionkey") == F.col("r")).groupBy("n_nationkey", "n_name").agg(F.sort_array(F.collect_list("inner")).alias("names"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for names in batch["names"]:
                data = io.BytesIO()
                with zipfile.ZipFile(data, "w") as archive:
                    for name in names:
                        archive.writestr(f"in/{name} ä.pdf", f"file of {name}")
                out.append(data.getvalue())
            yield pd.DataFrame({"path": batch["path"], "content": out})

    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("n_nationkey") % 28 + 1).cast("string"), 2, "0"), F.lit("-"), F.col("n_name"), F.lit(".zip"))
    packed = rows.select(day.alias("path"), "names").mapInPandas(pack, "path string, content binary")
    return made_once(spark, sf_dir, "zips", lambda folder: writers.write_files(packed, folder))


_ZIPS = "z AS (SELECT *, '2024-01-' || lpad((n_nationkey % 28 + 1)::VARCHAR, 2, '0') AS day, '2024-01-' || lpad((n_nationkey % 28 + 1)::VARCHAR, 2, '0') || '-' || n_name AS \"drop\" FROM nation)"


@registered(f"WITH {_ZIPS} SELECT \"drop\", \"drop\" || '/in/' || n.n_name || ' ä.pdf' AS path, sha256('file of ' || n.n_name) AS sha256 FROM z JOIN nation n ON z.n_regionkey = n.n_regionkey")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files inside drop zips."""
    return archives.member_digests(spark, _zips(spark, sf_dir)).select("drop", "path", "sha256")


@registered(f"WITH {_ZIPS} SELECT \"drop\" || '.zip' AS filename, day AS date, n_name AS custodian, CASE WHEN n_nationkey % 2 = 0 THEN 'sfi' END AS kind, CASE WHEN n_nationkey % 2 = 0 THEN 2024::INT END AS year FROM z")
def drops_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop zips against their metadata, both sides complete; written as the corpus metadata document and read again."""
    folder = _zips(spark, sf_dir)
    listing = files.drop_listing(spark, folder)
    rows = read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # a row for each drop
    named = {f"2024-01-{r.n_nationkey % 28 + 1:02}-{r.n_name}.zip": {"custodian": r.n_name} | ({"kind": "sfi", "year": 2024} if r.n_nationkey % 2 == 0 else {}) for r in rows}

    def write(place: str) -> None:
        writers.write_files(spark.createDataFrame([("metadata.yml", json.dumps(named).encode())], "path string, content binary"), place)
        metadata = tables.drop_metadata(spark, tables.load_yaml(f"{place}/metadata.yml"))
        tables.write_corpus_metadata(tables.checked_drops(listing, metadata), f"{place}/metadata.json")

    with fresh(spark, "drops") as place:
        write(place)
        return checkpointed(tables.read_corpus_metadata(spark, f"{place}/metadata.json").select("filename", "date", "custodian", "kind", "year"))


@registered(f"""WITH {_ZIPS} SELECT "drop" || '.zip' AS filename, CASE n_nationkey % 4 WHEN 0 THEN 'mismatch' WHEN 1 THEN 'unlisted' ELSE 'ok' END AS status FROM z
    UNION ALL SELECT 'gone-' || n_name || '.zip', 'missing' FROM nation""")
def zip_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zips' checksums, written as a manifest with some lines changed, left out or added, and checked against the files."""
    folder = _zips(spark, sf_dir)
    zips = trees.digests(trees.file_tree(spark, folder, r".*\.zip"), folder).withColumnRenamed("path", "filename")
    n = F.regexp_extract("filename", r"NATION_(\d+)", 1).cast("int") % 4
    listed = syncplan.manifest_of(zips).where(n != 1).select(F.concat(F.when(n == 0, F.sha2(F.lit("x"), 256)).otherwise(F.col("sha256")), F.lit("  "), "filename").alias("value"))
    more = read(spark, sf_dir, "nation").select(F.concat(F.sha2(F.lit("y"), 256), F.lit("  gone-"), "n_name", F.lit(".zip")).alias("value"))
    with fresh(spark, "manifest") as place:
        listed.unionByName(more).write.text(place)
        return checkpointed(syncplan.checksum_report(zips, tables.manifest(spark, place)))


# Conversations as scans: a third are statements with a text layer of a page for each turn; some cannot be recognised.
def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("turns"))
    statement, failed = F.col("conv_id") % 3 == 0, F.col("conv_id") % 41 == 1
    content = F.when(statement, F.concat(F.array_join("turns", "\f"), F.lit("\f"))).otherwise(F.concat(F.array_join("turns", "\x1e"), F.when(failed, "\x1d").otherwise("")))
    return turns.select(F.concat(F.when(statement, "forms/").otherwise("scans/"), _key("conv_id"), F.lit(".pdf")).alias("path"), content.cast("binary").alias("content"))


def _rendered(content: bytes) -> list[bytes]:
    return content.split(b"\x1e")


def _recognised(images: list[bytes]) -> list[dict]:
    if any(b"\x1d" in image for image in images):
        raise RuntimeError("not to be recognised")
    return [{"markdown": image.decode(), "html": "", "token_count": len(image), "num_chunks": 1, "num_images": 0} for image in images]


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ingest.Ingested]:
    contents = checkpointed(_scans(spark, sf_dir))
    done = spark.createDataFrame([("scans/2", "2", "md", "scans/2/2.md", "done before")], files.schemas.TEXTS)
    drops = tables.drop_metadata(spark, {"forms": {"kind": "sfi"}, "scans.zip": None})
    jobs = ingest.pending_jobs(contents.select("path"), done)
    return done, ingest.ingest(jobs, contents, drops, _rendered, _recognised, batch_pages=1, command=("sh", "-c", 'cat "$1"', "sh"))


_SCANS = r"""t AS (
        SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS lines, string_agg(text, '' ORDER BY turn, text) AS pages, string_agg(text, chr(12) ORDER BY turn, text) || chr(12) AS whole,
               bool_and(length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g')) >= 10) AS filled FROM conversations GROUP BY 1)"""


@registered(f"""WITH {_SCANS}, u AS (
        SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'forms/' ELSE 'scans/' END || conv_id AS dir, conv_id::VARCHAR AS stem, CASE WHEN conv_id = 2 THEN 'md' WHEN conv_id % 3 = 0 AND filled THEN 'txt' ELSE 'md' END AS ext,
               CASE WHEN conv_id = 2 THEN 'done before' WHEN conv_id % 3 = 0 AND filled THEN lines WHEN conv_id % 3 = 0 THEN whole ELSE pages END AS text FROM t WHERE conv_id = 2 OR conv_id % 3 = 0 OR conv_id % 41 <> 1)
    SELECT dir, stem, ext, dir || '/' || stem || '.' || ext AS text_path, text FROM u""")
def ingested_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of scans: text layers of statements, recognised pages of the others and of statements without a layer; written by drop beside what was done before, and read again."""

    def write(folder: str) -> None:
        done, out = _ingested(spark, sf_dir)
        files.write_texts(done, folder)
        files.write_texts(out.texts(), folder)

    with fresh(spark, "ingested") as folder:
        write(folder)
        return checkpointed(files.read_texts(spark, folder))


@registered("""WITH f AS (SELECT DISTINCT 'scans/' || conv_id || '.pdf' AS pdf FROM conversations WHERE conv_id % 3 <> 0 AND conv_id % 41 = 1 AND conv_id <> 2)
    SELECT * FROM (SELECT pdf AS line FROM f ORDER BY pdf LIMIT 3) UNION ALL SELECT 'and ' || count(*) - 3 || ' more' FROM f HAVING count(*) > 3""")
def ingest_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of scans that stay pending: the first three, and how many more there are."""
    return spark.createDataFrame([(line,) for line in ingest.failure_report(_ingested(spark, sf_dir)[1].failed, 3)], "line string")


@registered("SELECT count(DISTINCT conv_id) AS documents, count(*) AS pages, 12.5::DOUBLE AS minutes, round(750::DOUBLE / count(*), 1) AS seconds_per_page FROM conversations WHERE conv_id % 3 <> 0 AND conv_id % 41 <> 1")
def recognition_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many scans, and pages of them, were recognised in twelve and a half minutes, and the time a page took."""
    images = files.page_images(_scans(spark, sf_dir).where("path like 'scans/%'"), _rendered)
    results = checkpointed(files.recognise(images.where("not error"), _recognised, batch_pages=1))
    expected = results.groupBy("doc").agg(F.max("expected_pages").alias("expected_pages"))
    return ingest.throughput(rollup.complete_documents(rollup.page_rollup(results), expected), 750.0)


_SITE = """'<h1>A &amp; B</h1>'"""


@registered(rf"""
    WITH d AS (
        SELECT string_agg('<li><time datetime="' || day || '"><a href="' || CASE WHEN k % 4 = 0 THEN 'https://x/?a=1&amp;b=' || k ELSE 'https://files/drops/' || filename END || '">' || strftime(day::DATE, '%b ') || day(day::DATE) || strftime(day::DATE, ', %Y')
               || '</a></time><b>' || n_name || '</b>' || CASE WHEN k % 3 = 0 THEN '<p>from &lt;' || n_name || '&gt;</p>' ELSE '' END || '</li>', '' ORDER BY day DESC, filename DESC) AS items
        FROM (SELECT n_name, n_nationkey AS k, '2024-01-' || lpad((n_nationkey % 7 + 1)::VARCHAR, 2, '0') AS day, '2024-01-' || lpad((n_nationkey % 7 + 1)::VARCHAR, 2, '0') || '-' || n_name || '.zip' AS filename FROM nation)),
    c AS (SELECT count(*) FILTER (c_custkey % 3 <> 1) AS a, count(*) FILTER (c_custkey % 3 = 1) AS b FROM customer),
    f AS (
        SELECT string_agg('<label><input type="checkbox" value="' || lower(replace(replace(v, ' & ', '-'), ' ', '-')) || '" data-value="' || replace(v, '&', '&amp;') || '">' || replace(v, '&', '&amp;') || '</label>', '' ORDER BY k) AS boxes
        FROM (SELECT unnest(range(5)) AS k, unnest(['Financial Interest', 'Travel & Gifts', 'Appearance of Conflict', 'Other', 'Statement of Financial Interests']) AS v))
    SELECT 'index.html' AS path, {_SITE} || '<p>' || format('{{:,}}', a) || ' disclosures, ' || format('{{:,}}', b) || ' statements of financial interests</p><ol>' || items || '</ol>' AS html FROM c, d
    UNION ALL SELECT 'search/index.html', {_SITE} || '<form><fieldset data-filter="category">' || boxes || '</fieldset><fieldset data-filter="year"><label><input type="checkbox" value="2021" data-value="2021">2021</label><label><input type="checkbox" value="2020" data-value="2020">2020</label></fieldset></form>' FROM f""")
def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The home page and the search page, written as files and read again."""
    kind = F.col("c_custkey") % 3
    rows = read(spark, sf_dir, "customer").select(F.when(kind == 1, categories.STATEMENT).when(kind == 2, "Other").alias("category"), F.when(kind == 1, "2021-02").when(kind == 2, "2020").alias("date"))
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("n_nationkey") % 7 + 1).cast("string"), 2, "0"))
    own = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("https://x/?a=1&b="), _key("n_nationkey"))).otherwise("")
    notes = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("from <"), "n_name", F.lit(">")))
    drops = read(spark, sf_dir, "nation").select(F.concat(day, F.lit("-"), "n_name", F.lit(".zip")).alias("filename"), day.alias("date"), F.col("n_name").alias("custodian"), notes.alias("notes"), own.alias("url"))
    made = pages.home_page(rows, drops, "https://files/drops", "A & B").unionByName(pages.search_page(rows, tables.categories(spark), "A & B"))
    with fresh(spark, "site") as folder:
        writers.write_files(made, folder)
        return checkpointed(trees.with_text(trees.file_tree(spark, folder), folder).withColumnRenamed("text", "html"))


def _portal(spark: SparkSession, sf_dir: str) -> str:
    """Nations, each three times, as pages of ten portal items."""
    rows = read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # a dimension of 25 rows
    titles = [f"Form 2024/02/{r.n_nationkey + 1:02} - {r.n_name}" if k == 0 else f"Form 202403{r.n_nationkey % 5 + 10}-Roe-{r.n_name}" if k == 1 else "none" for k in range(3) for r in rows]
    items = [{"id": k, "properties": {"title": t, "name": f"n{k}.pdf"}} for k, t in enumerate(titles)]
    pages = [(f"{at + 1}.json", json.dumps({"features": items[at : at + 10]}).encode()) for at in range(0, len(items), 10)]
    return made_once(spark, sf_dir, "portal", lambda folder: writers.write_files(spark.createDataFrame(pages, "path string, content binary"), folder))


_PORTAL = """i AS (
        SELECT n_nationkey + 25 * k AS id, k, CASE k WHEN 0 THEN '2024/2024-02-' || lpad((n_nationkey + 1)::VARCHAR, 2, '0') || ' ' || n_name || '.pdf'
               WHEN 1 THEN '2024/2024-03-' || n_nationkey % 5 + 10 || ' ' || n_name || ' Roe.pdf' ELSE 'undated/n' || n_nationkey + 25 * k || '.pdf' END AS path FROM nation, range(3) t(k))"""


@registered(f"WITH {_PORTAL} SELECT id::VARCHAR AS id, path AS unique_path FROM i")
def portal_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of a paged portal, read until a page is not full, and where each is filed."""
    return portal.portal_items(spark, _portal(spark, sf_dir), page=10).select("id", "unique_path")


@registered(f"WITH {_PORTAL} SELECT path AS unique_path, CASE WHEN id % 11 <> 0 THEN 'bytes of ' || id END AS content, id % 11 = 0 AS failed FROM i WHERE id % 4 <> 0")
def portal_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of the items that are not there yet; an item that fails keeps its error and does not stop the others."""
    items = portal.portal_items(spark, _portal(spark, sf_dir), page=10)
    have = items.where("cast(id as int) % 4 = 0").select("unique_path")

    def fetch(item: str) -> bytes:
        if int(item) % 11 == 0:
            raise OSError("not there")
        return f"bytes of {item}".encode()

    return portal.fetch_missing(items, have, fetch).select("unique_path", F.col("content").cast("string").alias("content"), F.col("error").isNotNull().alias("failed"))


@registered(f"""WITH {_FILES}, w AS (SELECT 'n' || doc_id || '.pdf' AS name, path, doc_id FROM files)
    SELECT name, CASE WHEN doc_id % 3 <> 0 THEN path END AS target, CASE doc_id % 3 WHEN 0 THEN 'remove' WHEN 1 THEN 'keep' ELSE 'link' END AS action FROM w""")
def link_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror of hard links: two of three documents are wanted, two of three are there, every third of each."""
    pdfs = _pdf_tree(spark, sf_dir)
    rows = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("n"), _key(), F.lit(".pdf")).alias("filename"), _place().alias("original_path"))

    def link(folder: str) -> None:
        there = rows.where("doc_id % 3 <> 2").select(F.col("filename").alias("name"), F.col("original_path").alias("target"), F.lit("link").alias("action"))
        publish.apply_links(there, pdfs, folder)

    folder = made_once(spark, sf_dir, "mirror", link)
    return publish.link_plan(rows.where("doc_id % 3 <> 0"), spark, pdfs, folder)


@registered("SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders done by two incremental runs over files that come in, each order once, after a first run over a part of them."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")

    def run(folder: str) -> None:
        work = lambda batch: batch.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))
        for part in (rows.where("o_orderkey % 3 = 0"), rows.where("o_orderkey % 2 = 0"), rows):  # most come more than once
            part.write.mode("append").parquet(f"{folder}/in")
            incremental.run_pending(spark, f"{folder}/in", rows.schema, f"{folder}/out", f"{folder}/mark", work, "o_orderkey")

    with fresh(spark, "stream") as folder:
        run(folder)
        return checkpointed(incremental.read_batches(spark, f"{folder}/out"))


@registered("""SELECT conv_id::VARCHAR AS doc, count(*)::INT AS num_pages, string_agg(text, '' ORDER BY turn) AS markdown, sum(length(text))::BIGINT AS total_token_count FROM conversations
    GROUP BY 1 HAVING NOT bool_or((conv_id * 7 + turn) % 41 = 0)""")
def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents collected from a stream of pages that come in two parts, each once it is complete; one with a failed page never is."""
    rows = read(spark, sf_dir, "conversations").where("text is not null")
    sizes = rows.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").cast("int").alias("expected_pages"))
    rows = rows.join(sizes, F.col("conv_id") == F.col("c")).select(
        _key("conv_id").alias("doc"), F.col("turn").cast("int").alias("page_num"), "expected_pages", F.col("text").alias("markdown"), F.length("text").alias("token_count"), ((F.col("conv_id") * 7 + F.col("turn")) % 41 == 0).alias("error")
    )

    def run(folder: str) -> None:
        for part in (rows.where("page_num % 2 = 1"), rows.where("page_num % 2 = 0")):
            part.write.mode("append").parquet(f"{folder}/in")
            stream = incremental.collect_pages(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
            write = stream.writeStream.foreachBatch(incremental.once(f"{folder}/out", f"{folder}/mark")).option("checkpointLocation", f"{folder}/mark")
            write.trigger(availableNow=True).start().awaitTermination()

    with fresh(spark, "pages") as folder:
        run(folder)
        return checkpointed(incremental.read_batches(spark, f"{folder}/out"))


# Search requests: what the page shows for them.
_OPTIONS = {"category": ("de", "en", "es", "fr"), "year": tuple(str(y) for y in range(2019, 1999, -1))}


_COLLIDING = """CASE p_partkey % 6 WHEN 0 THEN 'Ring' WHEN 1 THEN 'ring_1' WHEN 2 THEN 'RING_1_1' WHEN 3 THEN 'gear_' || p_size WHEN 4 THEN 'gear' ELSE 'bolt' END"""


@registered(f"""
    WITH RECURSIVE s AS (SELECT p_partkey, {_COLLIDING} AS stem FROM part),
    p AS (SELECT *, lower(stem) AS low, lower(stem[:4]) AS root, row_number() OVER (PARTITION BY lower(stem[:4]) ORDER BY p_partkey) AS i, row_number() OVER (PARTITION BY lower(stem) ORDER BY p_partkey) - 1 AS c FROM s),
    r AS (
        SELECT root, i, p_partkey, stem || '.pdf' AS filename, [low || '.pdf'] AS taken FROM p WHERE i = 1
        UNION ALL
        SELECT root, i, p_partkey, name, list_append(taken, lower(name)) FROM (
            SELECT p.root, p.i, p.p_partkey, r.taken,
                   list_filter(list_transform(range(p.c, p.c + 70), lambda k: p.stem || CASE WHEN k > 0 THEN '_' || k ELSE '' END || '.pdf'), lambda x: NOT list_contains(r.taken, lower(x)))[1] AS name
            FROM r JOIN p ON p.root = r.root AND p.i = r.i + 1))
    SELECT p_partkey, filename FROM r""")
def colliding_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique names where the numbers that one name's copies get are other names."""
    parts = read(spark, sf_dir, "part").select("p_partkey", F.expr(_COLLIDING).alias("stem"), F.lit(".pdf").alias("ext"))
    return naming.unique_names(parts, "p_partkey", "p_partkey")


def _index(spark: SparkSession, sf_dir: str) -> search.Index:
    from docketry.plans import registry

    return registry._index(spark, sf_dir)


@registered(r"""
    WITH docs AS (
        SELECT lpad(doc_id::VARCHAR, 12, '0') AS filename, lang, source, text,
               CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN (2000 + doc_id % 20)::VARCHAR ELSE (2000 + doc_id % 20) || '-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') END AS date,
               regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents),
    n AS (SELECT count(*) AS n, avg(len(words)) AS avg_length FROM docs),
    m AS (SELECT ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'] AS names),
    tf AS (SELECT *, len(list_filter(words, lambda w: w = 'that')) AS a, len(list_filter(words, lambda w: w = 'with')) AS b FROM docs),
    df AS (SELECT count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM tf),
    hits AS (
        SELECT *, (ln(1 + (n - da + 0.5::DOUBLE) / (da + 0.5::DOUBLE)) * a * 2.2::DOUBLE / (a + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(words) / avg_length))
                 + ln(1 + (n - db + 0.5::DOUBLE) / (db + 0.5::DOUBLE)) * b * 2.2::DOUBLE / (b + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(words) / avg_length))) AS score
        FROM tf, df, n WHERE a > 0 AND b > 0 AND lang IN ('en', 'fr')),
    r AS (
        SELECT 'newest' AS sort, *, row_number() OVER (ORDER BY date DESC NULLS LAST, filename) AS rank FROM hits UNION ALL
        SELECT 'oldest', *, row_number() OVER (ORDER BY date NULLS LAST, filename) FROM hits UNION ALL
        SELECT 'relevance', *, row_number() OVER (ORDER BY round(score, 9) DESC, filename) FROM hits),
    t AS (SELECT count(*) AS total, least(2, greatest(1, (count(*) + 19) // 20)) AS page FROM hits),
    w AS (SELECT * FROM r, t, m WHERE rank > 20 * (page - 1) AND rank <= 20 * page)
    SELECT sort, total, page, 'https://files/' || filename AS url, source || '.pdf' AS title,
           array_to_string(list_filter([CASE WHEN len(date) = 7 THEN names[date[6:7]::INT] || ' ' || date[1:4] ELSE date END, source, lang], lambda x: x IS NOT NULL), ' · ') AS details FROM w""")
def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page (or the last, if there is none) of a search in each order: total, page shown, addresses, titles and details."""
    out = None
    for sort in request.SORTS:
        rows, _, total, page = search.search(_index(spark, sf_dir), request.SearchRequest("that WITH", {"category": ("en", "fr")}, sort, 2))
        part = rows.select(F.lit(sort).alias("sort"), F.lit(total).cast("long").alias("total"), F.lit(page).cast("long").alias("page"), "url", "title", "details")
        out = part if out is None else out.unionByName(part)
    return out


@registered(r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, text, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS parts FROM documents),
    e AS (SELECT row, unnest(parts) AS part, unnest(range(len(parts))) AS k FROM d),
    p AS (SELECT row, part, sum(length(part)) OVER (PARTITION BY row ORDER BY k) - length(part) AS pos FROM e),
    h AS (SELECT row, pos, count(*) OVER (PARTITION BY row ORDER BY pos RANGE BETWEEN CURRENT ROW AND 149 FOLLOWING) AS n FROM p WHERE lower(part) IN ('the', 'und', 'des', 'los')),
    b AS (SELECT row, pos FROM h QUALIFY row_number() OVER (PARTITION BY row ORDER BY n DESC, pos) = 1),
    w AS (SELECT doc_id, text, substr(text, greatest(coalesce(pos, 0) - 49, 1)::BIGINT, 200) AS shown FROM d LEFT JOIN b USING (row))
    SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(list_transform(regexp_extract_all(shown, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda x:
        CASE WHEN lower(x) IN ('the', 'und', 'des', 'los') THEN '<mark>' || x || '</mark>' ELSE replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') END), ''), '') END AS excerpt FROM w""")
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excerpts of whole texts where four words stand closest."""
    return read(spark, sf_dir, "documents").select("doc_id", search.excerpt(F.col("text"), ["the", "und", "des", "los"]).alias("excerpt"))


@registered(r"""
    WITH docs AS (SELECT lang, CASE WHEN doc_id % 11 <> 0 THEN (2000 + doc_id % 20)::VARCHAR END AS year, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents),
    hits AS (SELECT * FROM docs WHERE list_contains(words, 'und')),
    c AS (SELECT 'category' AS facet, lang AS value, count(*) AS n FROM hits WHERE year IN ('2003', '2004') GROUP BY 2 UNION ALL SELECT 'year', year, count(*) FROM hits WHERE lang IN ('en') AND year IS NOT NULL GROUP BY 2),
    d AS (SELECT 'category' AS facet, unnest(['de', 'en', 'es', 'fr', 'xx']) AS value UNION ALL SELECT 'year', (2000 + k)::VARCHAR FROM range(25) t(k))
    SELECT d.facet, d.value, coalesce(n, 0)::BIGINT AS n, (d.facet = 'category' AND d.value = 'en') OR (d.facet = 'year' AND d.value IN ('2003', '2004')) AS checked,
           coalesce(n, 0) = 0 AND NOT ((d.facet = 'category' AND d.value = 'en') OR (d.facet = 'year' AND d.value IN ('2003', '2004'))) AS disabled
    FROM d LEFT JOIN c ON c.facet = d.facet AND c.value = d.value""")
def facet_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every facet value with its count, whether it is ticked, and whether it is disabled for want of matches."""
    filters = {"category": ("en",), "year": ("2003", "2004")}
    values = [("category", v) for v in (*_OPTIONS["category"], "xx")] + [("year", str(2000 + k)) for k in range(25)]
    counts = search.facet_counts(search.candidates(_index(spark, sf_dir), "und"), filters)
    return search.facet_options(spark.createDataFrame(values, "facet string, value string"), counts, filters)


@registered(r"""
    WITH docs AS (SELECT lpad(doc_id::VARCHAR, 12, '0') AS filename, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents)
    SELECT 'https://files/' || filename AS url FROM docs WHERE list_contains(words, 'with') AND list_contains(words, 'the')""")
def preloaded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search over the postings that were put in memory while its last word was being typed."""
    with _index(spark, sf_dir).preloaded("with th") as warm:
        return checkpointed(search.matches(warm, "with the").select("url"))


@registered("""
    SELECT s_suppkey, CASE WHEN q = '' AND c = '' AND s_suppkey % 4 IN (0, 3) AND p = 1 THEN '/search/' ELSE '/search/?' || array_to_string(list_filter([
               CASE WHEN q <> '' THEN 'q=' || q END, CASE WHEN c <> '' THEN 'category=' || c END, CASE s_suppkey % 4 WHEN 1 THEN 'sort=newest' WHEN 2 THEN 'sort=oldest' END, CASE WHEN p > 1 THEN 'page=' || p END], lambda x: x IS NOT NULL), '&') END AS url,
           CASE WHEN c = '' THEN 0 ELSE len(string_split(c, '%2C')) END::BIGINT AS ticked
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'a%26b+' || s_suppkey END AS q, ['', 'de', 'de%2Cen', 'en%2Cfr'][s_suppkey % 4 + 1] AS c, greatest(1, s_suppkey % 6 - 2) AS p FROM supplier)""")
def search_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses parsed to search states, with unknown and repeated values, odd sorts and pages, and written again without what is default."""
    sorts, slugs = ("toString", "newest", "oldest", "relevance"), ("zz", "de,de", "en,DE,de", "fr,zz,en")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k in batch["s_suppkey"]:
                q = "%20" if k % 5 == 0 else f"%20a%26b+{k}"
                state = request.parse_url(f"https://x/search/?page={k % 6 - 2}&q={q}&sort={sorts[k % 4]}&category={slugs[k % 4]}&year=1800", _OPTIONS)
                out.append((request.url_for(state, _OPTIONS), request.selected(state.filters)))
            yield pd.DataFrame({"s_suppkey": batch["s_suppkey"], "url": [u for u, _ in out], "ticked": [n for _, n in out]})

    return read(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(run, "s_suppkey long, url string, ticked long")


@registered("""
    SELECT s_suppkey, CASE WHEN total = 0 THEN 'No ' || noun || 's' || asked || scope || '.' ELSE format('{:,}', total) || ' ' || noun || CASE WHEN total = 1 THEN '' ELSE 's' END || asked || scope || ' · showing '
               || format('{:,}', first) || '–' || format('{:,}', least(first + 19, total)) END AS sentence
    FROM (SELECT *, (least(s_suppkey % 90 + 1, greatest(1, (total + 19) // 20)) - 1) * 20 + 1 AS first FROM (
        SELECT s_suppkey, (s_suppkey % 50) * (s_suppkey % 50)::BIGINT AS total, CASE WHEN s_suppkey % 2 = 0 THEN 'disclosure' ELSE 'result' END AS noun, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE ' for q' || s_suppkey END AS asked,
               CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' in en or fr' ELSE ' in de from 2001 or 2000' END AS scope FROM supplier))""")
def search_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence over the results of many requests."""
    scopes = ({}, {"category": ("en", "fr")}, {"category": ("de",), "year": ("2001", "2000")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k in batch["s_suppkey"]:
                asked, total = request.SearchRequest("" if k % 2 == 0 else f"q{k}", scopes[k % 3], page=k % 90 + 1), (k % 50) ** 2
                first = (min(asked.page, max(1, -(-total // request.PAGE_SIZE))) - 1) * request.PAGE_SIZE
                out.append(request.summary(asked, total, min(request.PAGE_SIZE, total - first)))
            yield pd.DataFrame({"s_suppkey": batch["s_suppkey"], "sentence": out})

    return read(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(run, "s_suppkey long, sentence string")
