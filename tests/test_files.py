"""Trees, archives and writers of files."""

import hashlib
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from docketry.sources import archives, trees, writers


def fill(root, files):
    for path, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        with open(f"{root}/{path}", "wb") as file:
            file.write(data)


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("many"))
    fill(root, {f"drop {k % 3}/{k % 40}/x{k}/_d.pdf" if k % 2 else f"drop {k % 3}/f{k}.pdf": str(k).encode() if k % 5 else b"" for k in range(3000)})
    fill(root, {"drop 0/.hidden/a.pdf": b"", ".dot/a.pdf": b"", "top.pdf": b"t", "drop 1/a b%20c+ü.pdf": b"u"})
    return root


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_all_files_are_listed_once(spark, many, scheme):
    found = trees.file_tree(spark, scheme + many, r".*\.pdf").collect()
    expected = {os.path.relpath(os.path.join(d, f), many): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(many) for f in names}
    expected = {p: n for p, n in expected.items() if not any(part.startswith(".") for part in p.split("/"))}
    assert len(found) == len(expected) == 3002 and {r.path: r.size for r in found} == expected


def test_the_driver_lists_two_levels_at_most(many, monkeypatch):
    listed = []
    plain = trees._entries
    monkeypatch.setattr(trees, "_entries", lambda store, folder: listed.append(folder) or plain(store, folder))
    parts = trees._TreeReader({"root": many, "parts": "32"}).partitions()
    assert len(listed) == 1 + 3 and len(parts) > 32
    listed.clear()
    assert len(trees._TreeReader({"root": many, "parts": "2"}).partitions()) == 4 and len(listed) == 1


def test_listing_of_nothing_and_of_no_folder(spark, tmp_path):
    assert trees.file_tree(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="is no folder"):
        trees.file_tree(spark, str(tmp_path / "none")).count()


def test_contents_and_digests_are_dealt_to_tasks(spark, many):
    files = trees.file_tree(spark, many, r".*\.pdf")
    got = {r.path: (r.sha256, r.part) for r in trees.digests(files, many).withColumn("part", F.spark_partition_id()).collect()}
    contents = {r.path: bytes(r.content) for r in trees.read_contents(files, many).collect()}
    assert len(contents) == 3002 and {p: hashlib.sha256(c).hexdigest() for p, c in contents.items()} == {p: s for p, (s, _) in got.items()}
    assert contents["drop 1/a b%20c+ü.pdf"] == b"u" and len({part for _, part in got.values()}) == 4


def packed(files, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.mkdir("empty folder")
        for name, data in files.items():
            archive.writestr(zipfile.ZipInfo(name), data, method)
    return out.getvalue()


@pytest.fixture(scope="module")
def zips(tmp_path_factory):
    root, pick = str(tmp_path_factory.mktemp("zips")), random.Random(1)
    large = b"".join(pick.choice([b"line of a form\n", b"\x00" * 50]) for _ in range(400_000))
    content = {"a": {"in/ä b.pdf": b"pdf", "empty.pdf": b"", "large.bin": large} | {f"many/{k}.pdf": str(k).encode() * 9 for k in range(200)}, "b": {"x.pdf": b"bz" * 5000}, "c": {"x.pdf": b"stored" * 999}, "d": {}}
    fill(root, {"a.zip": packed(content["a"]), "b.zip": packed(content["b"], zipfile.ZIP_BZIP2), "c.zip": b"before the zip" + packed(content["c"], zipfile.ZIP_STORED), "d.zip": packed({}), "notes.txt": b"no zip"})
    return root, {f"{drop}/{name}": data for drop, files in content.items() for name, data in files.items()}


def test_members_are_listed_and_dealt(spark, zips):
    root, expected = zips
    assert {(r.path, r.size) for r in archives.zip_members(spark, root).collect()} == {(p, len(d)) for p, d in expected.items()}
    rows = archives.member_digests(spark, root).withColumn("part", F.spark_partition_id()).collect()
    assert {r.path: r.sha256 for r in rows} == {p: hashlib.sha256(d).hexdigest() for p, d in expected.items()}
    assert len({r.part for r in rows if r.drop == "a"}) == 4  # one zip in all tasks
    assert {r.path: bytes(r.content) for r in archives.unzip(spark, root).collect()} == expected


def test_streams_come_in_bounded_pieces(zips):
    root, expected = zips
    with open(f"{root}/a.zip", "rb") as file, zipfile.ZipFile(f"{root}/a.zip") as archive:
        e = archive.getinfo("large.bin")
        parts = list(archives.member_stream(file, e.header_offset, e.compress_size, e.file_size, e.compress_type, e.CRC, e.flag_bits))
        assert b"".join(parts) == expected["a/large.bin"] and max(map(len, parts)) <= 1 << 20 < len(expected["a/large.bin"])
        for wrong in ({"crc": 1}, {"size": 5}, {"flags": 1}, {"at": 3}, {"method": 99}):
            given = {"at": e.header_offset, "packed": e.compress_size, "size": e.file_size, "method": e.compress_type, "crc": e.CRC, "flags": 0} | wrong
            with pytest.raises(zipfile.BadZipFile):
                list(archives.member_stream(file, **given))


def test_extracted_files_are_whole(spark, zips, tmp_path):
    root, expected = zips
    for _ in range(2):  # a second run replaces what is there
        rows = archives.extract(spark, root, str(tmp_path)).collect()
    found = {os.path.relpath(os.path.join(d, f), tmp_path): os.path.join(d, f) for d, _, names in os.walk(tmp_path) for f in names}
    assert {r.path: r.size for r in rows} == {p: len(d) for p, d in expected.items()} and set(found) == set(expected)
    for path, place in found.items():
        with open(place, "rb") as file:
            assert file.read() == expected[path]
    assert not [d for d in os.listdir(tmp_path) if d.startswith(".")]


def test_members_do_not_leave_the_folder(spark, tmp_path):
    fill(str(tmp_path / "zips"), {"a.zip": packed({"../../out.pdf": b"x"})})
    with pytest.raises(Exception, match="does not lie below"):
        archives.extract(spark, str(tmp_path / "zips"), str(tmp_path / "in" / "folder"))
    assert not (tmp_path / "out.pdf").exists() and not (tmp_path / "in" / "out.pdf").exists()


def test_an_attempt_that_fails_leaves_no_part_of_a_file(tmp_path):
    def broken():
        yield b"half"
        raise RuntimeError("lost")

    fill(str(tmp_path), {"old.pdf": b"old"})
    with pytest.raises(RuntimeError), writers.staged(str(tmp_path)) as place:
        place("whole.pdf", iter([b"a", b"b"]))
        place("old.pdf", broken())
    assert sorted(os.listdir(tmp_path)) == ["old.pdf", "whole.pdf"] and (tmp_path / "old.pdf").read_bytes() == b"old" and (tmp_path / "whole.pdf").read_bytes() == b"ab"


def test_two_attempts_of_a_task_do_not_meet(tmp_path):
    with writers.staged(str(tmp_path), "-job") as one, writers.staged(str(tmp_path), "-job") as two:
        slow = iter([b"1" * 10, b"2" * 10])

        def both():
            yield next(slow)
            two("a.pdf", iter([b"3" * 20]))
            yield next(slow)

        one("a.pdf", both())
    assert (tmp_path / "a.pdf").read_bytes() == b"1" * 10 + b"2" * 10


def test_written_files_and_failed_jobs(spark, tmp_path):
    rows = spark.range(50).select(F.format_string("d%d/f%d.txt", F.col("id") % 3, "id").alias("path"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).cast("binary").alias("content"), F.lit("clash").alias("folder"))
    writers.write_files(rows, str(tmp_path))
    assert {r.path: r.size for r in trees.file_tree(spark, str(tmp_path)).collect()} == {f"d{k % 3}/f{k}.txt": len(str(k)) if k % 7 else 0 for k in range(50)}
    bad = rows.withColumn("path", F.when(F.col("folder").isNotNull() & F.col("path").endswith("f49.txt"), F.lit("/etc/x")).otherwise(F.concat(F.lit("new/"), "path")))
    with pytest.raises(Exception, match="does not lie below"):
        writers.write_files(bad, str(tmp_path))
    assert not [d for d in os.listdir(tmp_path) if d.startswith(".")]


def test_links_are_made_and_dropped_by_tasks(spark, tmp_path):
    pdfs, mirror = str(tmp_path / "pdfs"), str(tmp_path / "mirror")
    fill(pdfs, {f"d/{k}.pdf": str(k).encode() for k in range(20)})
    fill(mirror, {"gone.pdf": b"", "n1.pdf": b"other"})
    os.link(f"{pdfs}/d/2.pdf", f"{mirror}/n2.pdf")
    plan = spark.createDataFrame([(f"n{k}.pdf", f"d/{k}.pdf", "link") for k in range(20)] + [("gone.pdf", None, "remove"), ("never.pdf", None, "remove"), ("kept.pdf", None, "keep")], "name string, target string, action string")
    for _ in range(2):
        writers.write_links(plan, pdfs, mirror)
    assert sorted(os.listdir(mirror)) == sorted(f"n{k}.pdf" for k in range(20))
    assert all(os.path.samefile(f"{pdfs}/d/{k}.pdf", f"{mirror}/n{k}.pdf") for k in range(20))
