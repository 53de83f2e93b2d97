"""Lines of files by byte splits: against plain reading, at every split size, and the range index."""

import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from pagelex.sources import dump as D
from pagelex.sources import lines as LN


def bodies():
    rng = random.Random(1)
    out = [b"", b"\n", b"one", b"one\n", b"a\r\nb\n\nc\r\n", "é\n日本\r\nx".encode(), b"bad \xff byte\nfine\n", b"\r\n\r\n"]
    out.append(b"".join(b"x" * rng.randrange(60) + b"\n" for _ in range(200)))
    return out


def expected(body):
    got = body.split(b"\n")
    got = got[:-1] if got[-1] == b"" else got
    out = []
    for i, x in enumerate(got):
        x = x[:-1] if x.endswith(b"\r") and (i < len(got) - 1 or body.endswith(b"\n")) else x
        try:
            out.append(x.decode())
        except UnicodeDecodeError:
            out.append(None)
    return out


def archive(path, mode, files):
    """A folder first, then the members, a symbolic and a hard link to the first one, and a link to nothing."""
    with tarfile.open(path, mode) as tar:
        folder = tarfile.TarInfo("d")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for i, body in enumerate(files):
            info = tarfile.TarInfo(f"d/m{i}")
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
        for name, kind, to in (("d/s", tarfile.SYMTYPE, "m8"), ("h", tarfile.LNKTYPE, "d/m4"), ("n", tarfile.SYMTYPE, "none")):
            info = tarfile.TarInfo(name)
            info.type, info.linkname = kind, to
            tar.addfile(info)


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    top = tmp_path_factory.mktemp("lines")
    files = bodies()
    out = []
    for i, body in enumerate(files):
        (top / f"p{i}.json").write_bytes(body)
        out.append((str(top / f"p{i}.json"), [body]))
    archive(top / "a.tar", "w", files)
    archive(top / "b.tar.gz", "w:gz", files)
    out += [(str(top / "a.tar"), [*files, files[8], files[4]]), (str(top / "b.tar.gz"), [*files, files[8], files[4]])]
    return out


def rows(paths):
    return {(p, k + 1, i + 1): x for p, files in paths for k, body in enumerate(files) for i, x in enumerate(expected(body))}


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_every_line_once_at_any_split(spark, paths, size):
    if size == 1:  # a split a byte
        paths = paths[4:8]
    got = LN.read_lines(spark, [p for p, _ in paths], numbered=True, split_bytes=size).collect()
    want = rows(paths)
    assert {(r.path, r.file_number, r.line_number): r.value for r in got} == want and len(got) == len(want)
    assert len({r.line_id for r in got}) == len(got)


def test_ids_are_the_same_with_other_splits_and_without_numbers(spark, paths):
    names = [p for p, _ in paths]
    some = {(r.path, r.line_id, r.value) for r in LN.read_lines(spark, names, split_bytes=64).collect()}
    assert some == {(r.path, r.line_id, r.value) for r in LN.read_lines(spark, names, numbered=True).collect()}


@pytest.mark.parametrize("start,end", [("1:1", "1:3"), ("3", None), ("2:2", "9:100"), ("9:150", "10:160"), ("12", "20"), ("40:1", None)])
def test_range_against_plain_reading(spark, paths, start, end):
    (sf, sl), (ef, el) = D.line_address(start), D.line_address(end) if end else (10**9, 10**9)
    want = {k: v for k, v in rows(paths).items() if sf <= k[1] <= ef and sl <= k[2] <= el}
    got = LN.read_lines(spark, [p for p, _ in paths], start, end, split_bytes=50).collect()
    assert {(r.path, r.file_number, r.line_number): r.value for r in got} == want


def test_the_index_prunes_splits_before_they_are_read(spark, tmp_path):
    """Bytes to read shrink with the range; a kept index serves later slices, also where other splits can't be read any more."""
    f = tmp_path / "d.json"
    f.write_bytes(b"".join(b"%06d\n" % i for i in range(1, 10_001)))
    index = LN.line_index(LN.splits(spark, [str(f)], 1000))
    index.write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    size = lambda df: df.agg(F.sum(F.col("end") - F.col("start"))).collect()[0][0]
    assert size(index) == 70_000 and size(LN.in_range(index, "5000", "5100")) <= 2000
    data = bytearray(f.read_bytes())
    data[:30_000] = b"?" * 30_000
    f.write_bytes(bytes(data))
    got = LN.read_lines(spark, [str(f)], "9000", "9002", index=index).collect()
    assert sorted((r.line_number, r.value) for r in got) == [(9000, "009000"), (9001, "009001"), (9002, "009002")]


def test_a_packed_archive_is_dealt_out_to_many_tasks(spark, tmp_path):
    body = b"".join(json.dumps({"name": f"N{i}", "article_body": {"html": "<p>x</p>"}}).encode() + b"\n" for i in range(3000))
    archive(tmp_path / "a.tar.gz", "w:gz", [body] * 9)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = LN.read_lines(spark, [str(tmp_path / "a.tar.gz")])
        tasks = D.decode_dump_lines(lines).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 33_000


def test_lines_that_are_not_utf8_are_quarantined(spark, tmp_path):
    good = json.dumps({"name": "A", "article_body": {"html": "h"}}).encode()
    (tmp_path / "d.json").write_bytes(good + b"\n" + good[:-3] + b'\xff"}}\n')
    dec = D.decode_dump_lines(LN.read_lines(spark, [str(tmp_path / "d.json")]))
    assert [r.title for r in D.good_lines(dec).collect()] == ["A"]
    assert [r.reason for r in D.quarantine(dec).collect()] == ["not utf-8"]
