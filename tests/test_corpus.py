import datetime
import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from docketry.functions.display import delimit, drop_url, portal_path, slugify
from docketry.operators import boilerplate, naming, rollup, syncplan
from docketry.plans import corpus as corpora
from docketry.plans.corpus import build_corpus
from docketry.sources import files as sources
from docketry.sources import archives, portal, tables


def write(root, path, data):
    path = os.path.join(root, path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(data if isinstance(data, bytes) else data.encode())


@pytest.fixture
def tree(tmp_path):
    pdfs, texts = str(tmp_path / "pdfs"), str(tmp_path / "ocr")
    for path, data in {
        "2026-01-02-town/2012/Foo.pdf": b"one", "2026-01-02-town/2012/copy of Foo.PDF": b"one", "2026-01-02-town/gone.pdf": b"excluded",
        "2026-01-02-town/a/foo.pdf": b"two", "2026-01-02-town/nothing.pdf": b"no text", "loose.pdf": b"outside", "2026-01-02-town/.hidden.pdf": b"h",
    }.items():
        write(pdfs, path, data)
    for k in range(20):
        write(pdfs, f"2025-05-05-forms/f{k:02}.pdf", f"form {k}")
        write(texts, f"2025-05-05-forms/f{k:02}/f{k:02}.txt", f"Name of the form\n\n\nanswer   {k}\n" + ("rare line\n" if k < 18 else ""))
    write(texts, "2026-01-02-town/2012/Foo/Foo.md", "# DISCLOSURE OF GIFT\n**x**\nName of public employee: Jane Roe\nTitle: Clerk")
    write(texts, "2026-01-02-town/2012/Foo/Foo.txt", "never this one")
    write(texts, "2026-01-02-town/a/foo/foo.txt", "letter under § 6A, 2013 MAR 1 AM 2:00")
    return pdfs, texts


def test_corpus(spark, tree, tmp_path):
    pdfs, ocr = tree
    found = sources.scan_pdfs(spark, pdfs)
    texts = sources.scan_texts(spark, ocr)
    entries = {"2026-01-02-town.zip": {"custodian": "Town", "agency": "Town Hall", "note2": "x"}, "2025-05-05-forms": {"kind": "sfi", "year": 2025}, "2024-01-01-none": None}
    drops = tables.drop_metadata(spark, entries)
    import hashlib

    gone = tables.exclusions(spark, [hashlib.sha256(b"excluded").hexdigest()])
    corpus = build_corpus(found, texts, drops, gone, datetime.date(2026, 6, 1))
    rows = {r.original_path: r for r in corpus.collect()}
    assert len(rows) == 22
    one = rows["2026-01-02-town/2012/Foo.pdf"]
    assert (one.filename, one.category, one.date, one.date_source, one.name, one.title, one.agency, one.custodian) == ("copy_of_Foo.pdf", "Travel & Gifts", "2012", "folder", "Jane Roe", "Clerk", "Town Hall", "Town")
    assert one.original_filenames == ["Foo.pdf", "copy of Foo.PDF"] and one.fulltext.startswith("DISCLOSURE OF GIFT\nx\n")
    two = rows["2026-01-02-town/a/foo.pdf"]
    assert (two.filename, two.category, two.date, two.date_source) == ("foo.pdf", "Financial Interest", "2013-03-01", "received_stamp")
    form = rows["2025-05-05-forms/f03.pdf"]
    assert (form.category, form.date, form.date_source, form.fulltext, form.name, form.agency) == ("Statement of Financial Interests", "2025", "drop", "answer 3\nrare line", None, None)
    out = str(tmp_path / "corpus")
    tables.write_corpus(corpus, out)
    part = [f for f in os.listdir(out) if f.endswith(".json")]
    with open(os.path.join(out, part[0])) as file:
        lines = [json.loads(x) for x in file]
    assert len(part) == 1 and len(lines) == 22 and lines[0]["original_path"] == "2025-05-05-forms/f00.pdf" and lines[0]["name"] is None
    assert sorted(r.filename for r in tables.read_corpus(spark, out).collect()) == sorted(r.filename for r in rows.values())


def test_texts_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Their paths are measured, not they: 40 texts of 20,000 signs, where tables of up to 100,000 bytes are broadcast."""
    for k in range(40):
        write(str(tmp_path), f"pdfs/d/f{k}.pdf", f"form {k}")
        write(str(tmp_path), f"ocr/d/f{k}/f{k}.txt", f"{k} " * 10000)
    plans = []
    monkeypatch.setattr(corpora, "checkpointed", lambda df: plans.append(df) or df.checkpoint())
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        pdfs, texts = sources.scan_pdfs(spark, str(tmp_path / "pdfs")), sources.scan_texts(spark, str(tmp_path / "ocr"))
        built = build_corpus(pdfs, texts, tables.drop_metadata(spark, {}), tables.exclusions(spark, []), datetime.date(2026, 6, 1))
        read = [df for df in [*plans, built] if "fulltext" in df.columns]
        for df in read:
            assert len(df.collect()) == 40
            assert not re.search(r"BroadcastExchange(?:(?!Exchange).)*MapInArrow[^\n]*content", df._jdf.queryExecution().executedPlan().toString(), re.S)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert read


def test_no_file_is_passed_over(spark, tmp_path):
    import hashlib

    pdfs, ocr = str(tmp_path / "pdfs"), str(tmp_path / "ocr")
    for path, data in {"d/_a.pdf": b"1", "d/_dir/b.PDF": b"2", "_drop/c.pdf": b"3", "d/zero.pdf": b"", "d/.dot.pdf": b"4", "d/.dir/x.pdf": b"5", "d/_k=v.pdf": b"6", "loose.pdf": b"", "d/note.txt": b"", "d/e f+g%.pdf": b"7"}.items():
        write(pdfs, path, data)
    found = {r.path: r.sha256 for r in sources.scan_pdfs(spark, pdfs).collect()}
    assert found == {p: hashlib.sha256(d).hexdigest() for p, d in {"d/_a.pdf": b"1", "d/_dir/b.PDF": b"2", "_drop/c.pdf": b"3", "d/zero.pdf": b"", "d/_k=v.pdf": b"6", "d/e f+g%.pdf": b"7"}.items()}
    for path, data in {"d/_a/_a.md": b"\xc3\xa4", "d/zero/zero.txt": b"", "_drop/c/c.txt": b"x", "d/e f+g%/e f+g%.md": b"y", "d/w/w.pdf": b""}.items():
        write(ocr, path, data)
    texts = sorted((r.dir, r.stem, r.ext, r.text) for r in sources.scan_texts(spark, ocr).collect())
    assert texts == [("_drop/c", "c", "txt", "x"), ("d/_a", "_a", "md", "ä"), ("d/e f+g%", "e f+g%", "md", "y"), ("d/zero", "zero", "txt", "")]
    joined = {r.path: r.text_path for r in sources.with_text_paths(sources.scan_pdfs(spark, pdfs), sources.scan_texts(spark, ocr)).collect()}
    assert joined["d/zero.pdf"] == "d/zero/zero.txt" and joined["d/_a.pdf"] == "d/_a/_a.md" and joined["d/_k=v.pdf"] is None


def test_greedy_names(spark):
    assert list(naming.allocate([("Foo", ""), ("Foo", ""), ("Foo_1", ""), ("foo", "")])) == ["Foo", "Foo_1", "Foo_1_1", "foo_2"]
    pick = random.Random(5)
    rows = [(k, pick.choice(["a", "A", "a_1", "a_1_1", "b", "B_2", "c_", "_1"]), pick.choice([".pdf", ".PDF", ""])) for k in range(80)]
    rows += [(k, f"d_{pick.randint(0, 30)}" if pick.random() < 0.9 else pick.choice(["d", "D_1_2", "d_01", "e_1_1", "e", "e_1", "g_7_1"]), ".x") for k in range(80, 160)] + [(160, "h", ""), (161, "h_1_1", ""), (162, "h", ""), (163, "h_1", "")]
    frame = spark.createDataFrame(rows, "k int, stem string, ext string")
    got = {r.k: r.filename for r in naming.unique_names(frame, "k", "k").collect()}
    taken, model = set(), {}
    for k, stem, ext in rows:
        n, name = 0, stem + ext
        while name.lower() in taken:
            n += 1
            name = f"{stem}_{n}{ext}"
        taken.add(name.lower())
        model[k] = name
    assert got == model and len({v.lower() for v in got.values()}) == len(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_names_are_those_of_the_fold_in_order(spark, seed):
    pick = random.Random(seed)
    stems = ["a", "A", "a_1", "a_2", "a_3", "a_1_1", "a_1_2", "a_1_1_1", "a_2_1", "b_1", "b_1_1", "b_1_2", "c", "c_5", "c_01", "c_0", "c_99999999999999999999", "_1", "", "_1_1"]
    rows = [(k, pick.choice(stems[: pick.choice([4, 10, 20])]), pick.choice([".pdf", ".PDF", ""])) for k in range(300)]
    frame = spark.createDataFrame(rows, "k int, stem string, ext string")
    got = {r.k: r.filename for r in naming.unique_names(frame, "k", "k").collect()}
    assert got == dict(zip((r[0] for r in rows), naming.allocate((s, e) for _, s, e in rows), strict=True))


def test_a_line_of_many_rows_is_numbered_in_several_tasks(spark):
    pick = random.Random(8)
    stem = lambda k: pick.choice(["ring", "ring", "Ring", f"ring_{k % 2000}", "ring_1_1"])
    rows = [(k, stem(k), "") for k in range(20_000)]
    frame = spark.createDataFrame(rows, "k int, stem string, ext string")
    named = naming.unique_names(frame, "k", "k")
    got = {r.k: r.filename for r in named.collect()}
    assert got == dict(zip((r[0] for r in rows), naming.allocate((s, e) for _, s, e in rows), strict=True))
    parts = [r["count"] for r in named.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()]
    assert max(parts) < 15_000 and len(parts) > 2


def test_names_of_nothing(spark):
    assert naming.unique_names(spark.createDataFrame([], "k int, stem string, ext string"), "k", "k").count() == 0


def test_boilerplate_thresholds(spark):
    def docs(n, with_line):
        return spark.createDataFrame([("d", f"the form\n\nown {k}\n" * 2 if k < with_line else f"own {k}") for k in range(n)], "drop string, fulltext string")

    assert boilerplate.common_lines(docs(20, 19)).count() == 1
    assert boilerplate.common_lines(docs(20, 18)).count() == 0
    assert boilerplate.common_lines(docs(19, 19)).count() == 0
    assert boilerplate.strip_boilerplate(docs(20, 20)).orderBy("fulltext").first().fulltext == "own 0\n\nown 0"


def test_pages_to_documents(spark):
    rows = [("a", 2, "y", "<y>", 3, 1, 0, False), ("a", 1, "x", "<x>", 2, 1, 1, False), ("b", 1, "z", None, 1, 0, 0, True)]
    pages = spark.createDataFrame(rows, "doc string, page_num int, markdown string, html string, token_count int, num_chunks int, num_images int, error boolean")
    out = {r.doc: r for r in rollup.page_rollup(pages).collect()}
    assert (out["a"].markdown, out["a"].html, out["a"].total_token_count, out["a"].num_pages, out["b"].failed) == ("xy", "<x><y>", 5, 2, True)
    expected = spark.createDataFrame([("a", 2), ("b", 1)], "doc string, expected_pages int")
    assert [r.doc for r in rollup.complete_documents(rollup.page_rollup(pages), expected).collect()] == ["a"]
    batches = rollup.poison_batches(rollup.batched(pages.withColumn("part", F.lit(0)), ["doc", "page_num"], 2))
    assert [(r.doc, r.batch, r.error) for r in batches.orderBy("doc", "page_num").collect()] == [("a", 0, False), ("a", 0, False), ("b", 1, True)]


def test_recognition_in_batches(spark):
    pdfs = spark.createDataFrame([("a.pdf", b"abc"), ("b.pdf", b""), ("c.pdf", b"xyz!")], "path string, content binary").coalesce(1)
    pages = sources.page_images(pdfs, lambda content: [bytes([b]) for b in content])
    assert {(r.path, r.num_pages, r.error) for r in pages.collect()} == {("a.pdf", 3, False), ("b.pdf", 0, True), ("c.pdf", 4, False)}

    def infer(images):
        if b"!" in images:
            raise RuntimeError("no")
        return [{"markdown": i.decode(), "html": "", "token_count": 1, "num_chunks": 0, "num_images": 0} for i in images]

    done = sources.recognise(pages.where("not error"), infer, batch_pages=4)
    out = rollup.page_rollup(done)
    complete = rollup.complete_documents(out, done.groupBy("doc").agg(F.max("expected_pages").alias("expected_pages")))
    assert [(r.doc, r.markdown) for r in complete.collect()] == [("a.pdf", "abc")]


def test_text_layer_pages(spark):
    rows = [("1234567890\f1234567890\f",), ("1234567890\fshort\f",), ("no form feed",), ("",), (None,)]
    out = spark.createDataFrame(rows, "t string").select(sources.pages_of_text_layer(F.col("t")).alias("p")).collect()
    assert [r.p for r in out] == [["1234567890", "1234567890"], None, None, None, None]


def test_sync_plans(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "name string, target string")
    plan = {r.name: r.action for r in syncplan.mirror_plan(pairs([("a", "1"), ("b", "2"), ("c", "3")]), pairs([("b", "2"), ("c", "x"), ("d", "4")])).collect()}
    assert plan == {"a": "link", "b": "keep", "c": "link", "d": "remove"}
    sizes = lambda rows: spark.createDataFrame(rows, "name string, size long")
    local, remote = sizes([("a", 1), ("b", 2), ("c", 3)]), sizes([("b", 2), ("c", 9), ("d", 4)])
    assert {r.name: r.action for r in syncplan.bucket_plan(local, remote, 3).collect()} == {"a": "copy", "b": "keep", "c": "copy", "d": "delete"}
    with pytest.raises(ValueError, match="3 files"):
        syncplan.bucket_plan(local, remote, 4)
    listed = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "sha256 string, filename string")
    there = spark.createDataFrame([("1", "a"), ("9", "b"), ("4", "d")], "sha256 string, filename string")
    assert {r.filename: r.status for r in syncplan.checksum_report(there, listed).collect()} == {"a": "ok", "b": "mismatch", "c": "missing", "d": "unlisted"}
    assert [r.name for r in syncplan.pending(sizes([("c", 1), ("a", 1), ("b", 1)]), sizes([("a", 1)]), "name", 1).collect()] == ["b"]


def test_drops(spark, tmp_path):
    folder = str(tmp_path / "zips")
    import io
    import zipfile

    for name in ("2026-04-09-x.zip", "2026-02-30-y.zip", "bad.zip"):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as archive:
            archive.writestr("in/ä.pdf", b"pdf")
        write(folder, name, data.getvalue())
    listing = sources.drop_listing(spark, folder)
    assert [(r.filename, r.valid) for r in listing.collect()] == [("2026-02-30-y.zip", False), ("2026-04-09-x.zip", True), ("bad.zip", False)]
    assert {(r.drop, r.path, bytes(r.content)) for r in archives.unzip(spark, folder).where("drop like '2026-04%'").collect()} == {("2026-04-09-x", "2026-04-09-x/in/ä.pdf", b"pdf")}
    good = listing.where("valid")
    about = lambda *names: tables.drop_metadata(spark, {n: {"custodian": "c", "more": 1} for n in names})
    out = tables.checked_drops(good, about("2026-04-09-x.zip"))
    tables.write_corpus_metadata(out, str(tmp_path / "metadata.json"))
    with open(tmp_path / "metadata.json") as file:
        assert json.load(file) == {"drops": [{"filename": "2026-04-09-x.zip", "date": "2026-04-09", "custodian": "c", "more": "1"}]}
    assert tables.read_corpus_metadata(spark, str(tmp_path / "metadata.json")).first().date == "2026-04-09"
    for listed, names, reason in ((listing, ("2026-04-09-x",), "not named|no metadata"), (good, (), "no metadata"), (good, ("2026-04-09-x", "2026-04-10-z"), "no such zip")):
        with pytest.raises(ValueError, match=reason):
            tables.checked_drops(listed, about(*names))


def test_portal(spark, tmp_path):
    titles = ["Form 2026/03/25 - Jane Roe", "Form – 20260713-Roe-Jane-Q", "Form 2026/03/25 - Jane Roe", "no date"]
    features = [{"id": k, "properties": {"title": t, "name": f"n{k}.pdf"}} for k, t in enumerate(titles)]
    write(str(tmp_path), "1.json", json.dumps({"features": features[:3]}))
    write(str(tmp_path), "4.json", json.dumps({"features": features[3:]}))
    out = portal.portal_items(spark, str(tmp_path), page=3).orderBy("arrival").collect()
    assert [r.unique_path for r in out] == ["2026/2026-03-25 Jane Roe.pdf", "2026/2026-07-13 Jane Q Roe.pdf", "2026/2026-03-25 Jane Roe (2).pdf", "undated/n3.pdf"]


def test_small_expressions(spark):
    row = spark.range(1).select(
        delimit(F.lit("6883")).alias("a"), delimit(F.lit("-1234567")).alias("b"), delimit(F.lit("12")).alias("c"), delimit(F.lit("6883 PDFs")).alias("d"), slugify(F.lit("Travel & Gifts")).alias("e"),
        drop_url(F.lit(""), "https://f/drops/", F.lit("a b.zip")).alias("f"), portal_path(F.lit(" 2026/01/02 -  A/B "), F.lit("n")).alias("g"),
    ).first()
    assert tuple(row) == ("6,883", "-1,234,567", "12", "6883 PDFs", "travel-gifts", "https://f/drops/a+b.zip", "2026/2026-01-02 AB.pdf")


def test_categories_must_agree(spark):
    assert [r.slug for r in tables.categories(spark).orderBy("ord").collect()][:2] == ["financial-interest", "travel-gifts"]
    with pytest.raises(ValueError, match="differ"):
        tables.categories(spark, ["Other"])


def test_usage_shows_what_the_dimension_lacks(spark):
    rows = spark.createDataFrame([("Other",), ("Other",), ("other",), (None,)], "category string")
    got = {r.value: (r.documents, r.known) for r in tables.category_usage(tables.categories(spark), rows).collect()}
    assert got == {"Other": (2, True), "other": (1, False), None: (1, False), "Financial Interest": (0, True), "Travel & Gifts": (0, True), "Appearance of Conflict": (0, True), "Statement of Financial Interests": (0, True)}
    assert tables.category_usage(tables.categories(spark), rows.where("false")).count() == 5
