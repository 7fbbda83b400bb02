"""Archives cut into pieces and opened entry by entry give what ``zipfile`` gives."""

import io
import os
import random
import zipfile

import pyarrow as pa
import pytest

from lakegate.sources import archives as ar


def text_of(seed: int, lines: int) -> str:
    r = random.Random(seed)
    return "".join(f"{i};{r.random()};{r.choice(['a', 'é', ''])}\n" for i in range(lines))


def by_library(path: str) -> dict[str, list[str]]:
    with zipfile.ZipFile(path) as zf:
        return {n: zf.read(n).decode().splitlines() for n in zf.namelist() if ar._valid_entry(n)}


def by_pieces(spark, root: str) -> dict[str, dict[str, list[str]]]:
    got: dict = {}
    for r in ar.expand_archives(spark, root, skip_header=False).collect():
        assert r["status"] != "ERROR", r
        entry = got.setdefault(os.path.basename(r["archive"]), {}).setdefault(r["entry"], [])
        if r["status"] == "OK":
            entry.append((r["line_no"], r["line"]))
    return {a: {e: [x for _, x in sorted(lines)] for e, lines in es.items()} for a, es in got.items()}


@pytest.fixture()
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "3000")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def write_archives(root: str) -> None:
    os.makedirs(root)
    with zipfile.ZipFile(f"{root}/many.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for i in range(40):
            zf.writestr(f"d/sales_{i:02}.csv", text_of(i, i * 20))
        zf.writestr("__MACOSX/._x.csv", "junk")
        zf.comment = b"a comment with PK\x03\x04 inside, and PK"
    with zipfile.ZipFile(f"{root}/Methods.ZIP", "w") as zf:
        for k, method in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)):
            zf.writestr(f"m_{k}.csv", text_of(100 + k, 300), compress_type=method)
        zf.writestr("empty.csv", "")
        with zf.open("wide.csv", "w", force_zip64=True) as fh:
            fh.write(text_of(7, 500).encode())
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as zf:
        for i in range(5):
            zf.writestr(f"in_{i}.csv", text_of(i, 50))
    with zipfile.ZipFile(f"{root}/nested.zip", "w") as zf:  # entry marks inside entries
        zf.writestr("before.csv", text_of(1, 30))
        zf.writestr(".hidden.zip", inner.getvalue())
        zf.writestr("marks.csv", "PK\x03\x04;x\nPK\x03\x04PK\x03\x04\n" + text_of(2, 400) + "PK\x03\x04")
        zf.writestr("after.csv", text_of(3, 30))
    with open(f"{root}/prefixed.zip", "wb") as fh:  # as self-extracting archives are
        fh.write(b"#!/bin/sh PK\x03\x04 exit\n")
        with open(f"{root}/many.zip", "rb") as other:
            fh.write(other.read())


def test_entries_equal_the_library(spark, tmp_root, small_splits):
    root = f"{tmp_root}/z"
    write_archives(root)
    got = by_pieces(spark, root)
    assert sorted(got) == ["Methods.ZIP", "many.zip", "nested.zip", "prefixed.zip"]
    for name, entries in got.items():
        assert entries == by_library(f"{root}/{name}"), name


def test_an_archive_is_read_in_splits(spark, tmp_root, small_splits):
    root = f"{tmp_root}/s"
    write_archives(root)
    pieces = ar._pieces(spark, f"{root}/many.zip")
    assert pieces.rdd.getNumPartitions() > 4
    places = sorted((r["at"], r["n"]) for r in ar._places(pieces).collect())
    with open(f"{root}/many.zip", "rb") as fh:
        content = fh.read()
    assert places[0][0] == 0 and sum(n + 4 for _, n in places) == len(content) + 4
    assert all(content[at - 4:at] == b"PK\x03\x04" for at, _ in places[1:])


def test_broken_archives_and_entries(spark, tmp_root):
    root = f"{tmp_root}/b"
    write_archives(root)
    with open(f"{root}/many.zip", "rb") as fh:
        content = fh.read()
    for name in ("Methods.ZIP", "nested.zip", "prefixed.zip", "many.zip"):
        os.remove(f"{root}/{name}")
    at = content.index(b"PK\x03\x04", 4000)
    damaged = bytearray(content)
    damaged[at + 60:at + 70] = bytes(10)  # inside one entry's data
    for name, data in (("cut.zip", content[:-600]), ("damaged.zip", bytes(damaged)), ("text.zip", b"none")):
        with open(f"{root}/{name}", "wb") as fh:
            fh.write(data)
    with zipfile.ZipFile(f"{root}/nothing.zip", "w"):
        pass
    rows = ar.expand_archives(spark, root).where("status <> 'OK'").collect()
    errors = {(os.path.basename(r["archive"]), r["entry"]): r["error"] for r in rows if r["status"] == "ERROR"}
    assert {a for a, e in errors if e is None} == {"cut.zip", "text.zip", "nothing.zip"}
    assert errors["nothing.zip", None] == "No valid files in ZIP"
    assert errors["text.zip", None].startswith("Invalid ZIP file")
    bad = [e for a, e in errors if a == "damaged.zip"]
    assert len(bad) == 1 and errors["damaged.zip", bad[0]].startswith("Invalid ZIP entry")
    assert sum(r["status"] == "ENTRY" for r in rows) == 40


def test_no_archives(spark, tmp_root):
    os.makedirs(f"{tmp_root}/none")
    assert ar.expand_archives(spark, f"{tmp_root}/none").count() == 0


def test_entry_lines_leave_the_task_in_small_batches(tmp_root):
    path, lines = f"{tmp_root}/a.zip", [f"{i};\u00e9" if i % 7 else "" for i in range(25_000)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("orders_1.csv", "\n".join(lines))
    data = open(path, "rb").read()
    end = data.index(b"PK\x01\x02")
    record, piece = data[end:data.index(b"PK\x05\x06")], data[4:end]
    one = pa.RecordBatch.from_pylist([{"archive": "a.zip", "name": "orders_1.csv", "record": record, "pieces": [piece]},
                                      {"archive": "a.zip", "name": "lost.csv", "record": record, "pieces": []}])
    out = list(ar._expand(iter([one]), False, "utf-8"))
    assert max(b.num_rows for b in out) <= 10_000 and len({str(b.schema) for b in out}) == 1
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["status"] for r in rows] == ["ENTRY"] + ["OK"] * 25_000 + ["ENTRY", "ERROR"]
    assert [r["line"] for r in rows[1:-2]] == lines and rows[25_000]["row_no"] == sum(map(bool, lines))
    assert [r["row_no"] for r in rows[1:3]] == [None, 1] and rows[-1]["line_no"] is None and rows[-1]["entry"] == "lost.csv"
