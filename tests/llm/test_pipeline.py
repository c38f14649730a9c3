import random
import re
import zlib

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docketry.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and house river green running under small bright stone", "de": "der die und haus fluss grün laufen unter klein straße stein"}


def table(spark, extra=()):
    pick = random.Random(12)
    rows = []
    for k in range(120):
        lang = pick.choice(list(WORDS))
        text = " ".join(pick.choices(WORDS[lang].split(), k=pick.randint(20, 80)))
        rows.append((k, text, lang, pick.choice(["a", "b", None])))
    rows += [(200, rows[0][1], "en", "a"), (201, rows[1][1] + " und", "de", "b"), (202, "1 2 3", "en", "a"), (203, None, None, None), (204, "", "en", "b")]
    rows += [(205, rows[2][1] + " password = hunter2hunter2", "en", "a")]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in [*rows, *extra]], SCHEMA)


def test_stages_one_after_the_other(spark, tmp_path):
    docs = table(spark)
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = docs.collect()
        if name != "sequence_packing":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "secret_scan", "source_mixing", "sequence_packing"]
    ids = {n: [r.doc_id for r in rows] for n, rows in seen.items()}
    assert set(ids["language_id"]) == {*range(120), 200, 201, 205}
    assert 200 not in ids["ngram_join"] and len(set(ids["ngram_join"])) == len(ids["ngram_join"]) and set(range(120)) >= set(ids["ngram_join"]) - {201, 205}
    assert sorted(ids["secret_scan"]) == sorted(ids["ngram_join"]) and not any("hunter2" in r.text for r in seen["secret_scan"])
    assert all(r.n_chars == len(r.text) for r in seen["source_mixing"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = sum(size(r.text) for r in seen["secret_scan"])
    assert abs(sum(size(r.text) for r in seen["source_mixing"]) - 1.5 * total) <= 3
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["source_mixing"])
    assert sum(r.length for r in seen["sequence_packing"]) == tokens


def test_run_writes_in_the_shared_folder(spark, tmp_path):
    table(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_run_over_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries_cover_their_tables(spark, sf_dir):
    docs, pages = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/pages.parquet")
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
    for name, query in queries.QUERIES.items():
        out = query(spark, sf_dir)
        if name.startswith("op2_"):
            assert sorted({r.doc_id for r in out.select("doc_id").collect()}) == ids
        elif name.startswith("op9_"):
            assert out.count() == pages.count()
        else:
            assert sorted(r.doc_id for r in out.select("doc_id").collect()) == ids
    held = queries.op1_language_id(spark, sf_dir).where("held_out").select("doc_id").collect()
    assert {r.doc_id for r in held} == {k for k in ids if zlib.crc32(str(k).encode()) % 5 == 0}


def test_language_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet").select("doc_id", "lang")
    out = queries.op1_language_id(spark, f"{sf_dir}/../sf0.01").where("held_out").join(docs, "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
