import os

from docketry.plans import ingest, publish
from docketry.sources import tables


def test_texts_come_whole_or_not_at_all(spark, tmp_path):
    script = tmp_path / "layer.sh"
    script.write_text('#!/bin/sh\ncat "$1" | grep -q scan && exit 1\nprintf "a page of words\\fanother page of them\\f"\n')
    script.chmod(0o755)
    contents = spark.createDataFrame([("s/form.pdf", b"text"), ("s/scan.pdf", b"scan"), ("d/a.pdf", b"xy"), ("d/bad.pdf", b"!"), ("d/none.pdf", b""), ("d/done.pdf", b"q")], "path string, content binary").coalesce(1)
    texts = spark.createDataFrame([("d/done", "done", "md", "d/done/done.md", "t")], "dir string, stem string, ext string, text_path string, text string")
    drops = tables.drop_metadata(spark, {"s": {"kind": "sfi"}, "d": None})
    jobs = ingest.pending_jobs(contents.select("path"), texts)
    assert jobs.count() == 5 and [r.pdf for r in ingest.pending_jobs(contents.select("path"), texts, 2).collect()] == ["d/a.pdf", "d/bad.pdf"]

    def infer(images):
        if b"!" in images:
            raise RuntimeError("no")
        return [{"markdown": i.decode(), "html": "", "token_count": 1, "num_chunks": 0, "num_images": 0} for i in images]

    out = ingest.ingest(jobs, contents, drops, lambda c: [bytes([b]) for b in c], infer, batch_pages=1, command=("sh", str(script)))
    assert [(r.pdf, r.text) for r in out.layered.collect()] == [("s/form.pdf", "a page of words\nanother page of them")]
    assert sorted((r.pdf, r.markdown, r.total_token_count) for r in out.recognised.collect()) == [("d/a.pdf", "xy", 2), ("s/scan.pdf", "scan", 4)]
    assert ingest.failure_report(out.failed) == ["d/bad.pdf", "d/none.pdf"] and ingest.failure_report(out.failed, 1) == ["d/bad.pdf", "and 1 more"]


def test_links(spark, tmp_path):
    pdfs, folder = tmp_path / "pdfs", tmp_path / "out"
    (pdfs / "d").mkdir(parents=True)
    folder.mkdir()
    for name in "abc":
        (pdfs / "d" / f"{name}.pdf").write_bytes(name.encode())
    os.link(pdfs / "d" / "a.pdf", folder / "A.pdf")
    (folder / "B.pdf").write_bytes(b"old")
    (folder / "gone.pdf").write_bytes(b"x")
    corpus = spark.createDataFrame([("A.pdf", "d/a.pdf"), ("B.pdf", "d/b.pdf"), ("C.pdf", "d/c.pdf")], "filename string, original_path string")
    plan = publish.link_plan(corpus, spark, str(pdfs), str(folder))
    assert publish.apply_links(plan, str(pdfs), str(folder)) == {"link": 2, "keep": 1, "remove": 1}
    assert {p.name: p.read_bytes() for p in folder.iterdir()} == {"A.pdf": b"a", "B.pdf": b"b", "C.pdf": b"c"}
    assert publish.apply_links(publish.link_plan(corpus, spark, str(pdfs), str(folder)), str(pdfs), str(folder)) == {"link": 0, "keep": 3, "remove": 0}


def test_drop_table(spark):
    rows = [("a.zip", "2026-04-09", "c", "n", ""), ("b.zip", "2026-04-09", "c", None, "https://own")]
    out = publish.drop_table(spark.createDataFrame(rows, "filename string, date string, custodian string, notes string, url string"), "https://f/drops").collect()
    assert [(r.filename, r.received, r.href) for r in out] == [("b.zip", "Apr 9, 2026", "https://own"), ("a.zip", "Apr 9, 2026", "https://f/drops/a.zip")]


def test_only_missing_items_are_fetched_and_texts_are_kept_by_drop(spark, tmp_path):
    from docketry.sources import files, portal

    items = spark.createDataFrame([("1", "a.pdf"), ("2", "b.pdf"), ("x", "c.pdf")], "id string, unique_path string")

    def fetch(item):
        return int(item).to_bytes(1, "big")

    out = portal.fetch_missing(items, spark.createDataFrame([("b.pdf",)], "unique_path string"), fetch).collect()
    assert sorted((r.unique_path, bytes(r.content) if r.content else None, r.error is None) for r in out) == [("a.pdf", b"\x01", True), ("c.pdf", None, False)]
    files.write_texts(files.as_texts(spark.createDataFrame([("d/x/a.b.pdf", "t")], "pdf string, text string"), "txt"), str(tmp_path / "texts"))
    row = spark.read.parquet(str(tmp_path / "texts")).first()
    assert (row.drop, row.dir, row.stem, row.text) == ("d", "d/x/a.b", "a.b", "t")
    assert tuple(files.read_texts(spark, str(tmp_path / "texts")).first()) == ("d/x/a.b", "a.b", "txt", "d/x/a.b/a.b.txt", "t")


def test_from_bytes_to_corpus(spark, tmp_path):
    """Files are scanned, ingested, their texts written and read, and a corpus built, without anything between."""
    import datetime

    from docketry.plans.corpus import build_corpus
    from docketry.sources import files

    root = tmp_path / "pdfs"
    for path, data in {"2026-01-02-town/Roe 8.23.12.PDF": b"# DISCLOSURE OF GIFT", "2026-01-02-town/_x/_dash.pdf": b"DISCLOSURE OF TRAVEL", "2026-01-02-town/empty.pdf": b"", "2026-01-02-town/bad.pdf": b"!", "2025-05-05-forms/a.pdf": b"a statement of interests"}.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(data)
    script = tmp_path / "layer.sh"
    script.write_text('#!/bin/sh\nhead -c 100 "$1"; printf "\\f"\n')
    drops = tables.drop_metadata(spark, {"2025-05-05-forms": {"kind": "sfi", "year": 2025}, "2026-01-02-town": {"custodian": "Town"}})

    def infer(images):
        if b"!" in images:
            raise RuntimeError("no")
        return [{"markdown": i.decode(), "html": "", "token_count": 1, "num_chunks": 0, "num_images": 0} for i in images]

    contents = files.scan_contents(spark, str(root))
    assert contents.count() == 5
    nothing = spark.createDataFrame([], files.schemas.TEXTS)
    out = ingest.ingest(ingest.pending_jobs(contents.select("path"), nothing), contents, drops, lambda c: [c] if c else [], infer, batch_pages=1, command=("sh", str(script)))
    files.write_texts(out.texts(), str(tmp_path / "texts"))
    texts = files.read_texts(spark, str(tmp_path / "texts"))
    corpus = build_corpus(files.scan_pdfs(spark, str(root)), texts, drops, tables.exclusions(spark, []), datetime.date(2026, 6, 1)).collect()
    assert {r.original_path: (r.filename, r.category, r.date, r.fulltext, r.custodian) for r in corpus} == {
        "2026-01-02-town/Roe 8.23.12.PDF": ("Roe_8_23_12.pdf", "Travel & Gifts", "2012-08-23", "DISCLOSURE OF GIFT", "Town"),
        "2026-01-02-town/_x/_dash.pdf": ("dash.pdf", "Travel & Gifts", None, "DISCLOSURE OF TRAVEL", "Town"),
        "2025-05-05-forms/a.pdf": ("a.pdf", "Statement of Financial Interests", "2025", "a statement of interests", None),
    }
    assert ingest.failure_report(out.failed) == ["2026-01-02-town/bad.pdf", "2026-01-02-town/empty.pdf"]
    assert [r.pdf for r in ingest.pending_jobs(contents.select("path"), texts).orderBy("pdf").collect()] == ["2026-01-02-town/bad.pdf", "2026-01-02-town/empty.pdf"]
    sums = files.checksummed(spark.createDataFrame([("z/a.zip", b"")], "path string, content binary")).first()
    assert sums.filename == "a.zip" and sums.sha256.startswith("e3b0c442")


def test_the_extractor_and_the_model_see_each_document_once(spark, tmp_path):
    script, seen = tmp_path / "layer.sh", tmp_path / "seen"
    script.write_text(f'#!/bin/sh\necho layer $(cat "$1") >> {seen}\nexit 1\n')
    contents = spark.createDataFrame([("s/a.pdf", b"a"), ("s/b.pdf", b"b"), ("d/c.pdf", b"c"), ("d/bad.pdf", b"!")], "path string, content binary").coalesce(1)
    drops = tables.drop_metadata(spark, {"s": {"kind": "sfi"}, "d": None})
    nothing = spark.createDataFrame([], "dir string, stem string, ext string, text_path string, text string")

    def infer(images):
        with open(seen, "a") as file:
            file.write(f"model {images[0].decode()}\n")
        if images == [b"!"]:
            raise RuntimeError("no")
        return [{"markdown": "m", "html": "", "token_count": 1, "num_chunks": 0, "num_images": 0}]

    out = ingest.ingest(ingest.pending_jobs(contents.select("path"), nothing), contents, drops, lambda c: [c], infer, batch_pages=1, command=("sh", str(script)))
    assert ingest.failure_report(out.failed) == ["d/bad.pdf"] and out.texts().count() == 3
    assert sorted(seen.read_text().splitlines()) == ["layer a", "layer b", "model !", "model a", "model b", "model c"]


def test_pages_of_many_documents_come_in_one_frame(spark):
    from pyspark.sql import functions as F

    from docketry.sources import files

    pdfs = spark.range(300).select(F.col("id").cast("string").alias("path"), F.lit(b"xy").alias("content")).coalesce(1)

    def counted(batches):
        for batch in batches:
            yield batch.slice(0, 1)

    pages = files.page_images(pdfs, lambda c: [c[:1], c[1:]])
    results = files.recognise(pages, lambda images: [{"markdown": "m", "html": "", "token_count": 1, "num_chunks": 0, "num_images": 0} for _ in images], batch_pages=1)
    assert pages.mapInArrow(counted, pages.schema).count() == 1 and results.count() == 600 and results.mapInArrow(counted, results.schema).count() == 1
