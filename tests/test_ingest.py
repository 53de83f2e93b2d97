"""The streaming entry: files that arrive between runs, an archive among them, bad lines, ids over batches."""

import io
import json
import tarfile

from pagelex.streaming import ingest

from helpers import make_dims


def line(name):
    return json.dumps({"name": name, "article_body": {"html": f"<p>{name}</p>"}}) + "\n"


def test_files_that_arrive_between_runs(spark, tmp_path):
    dims = make_dims(spark)
    (tmp_path / "in").mkdir()
    run = lambda: ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), dims).awaitTermination()
    (tmp_path / "in" / "a.json").write_text(line("A1") + "{bad\n" + line("A1"))
    body = line("T1").encode()
    with tarfile.open(tmp_path / "in" / "b.tar", "w") as tar:
        info = tarfile.TarInfo("m")
        info.size = len(body)
        tar.addfile(info, io.BytesIO(body))
    run()
    first = {(r.content_id, r.title) for r in ingest.read_batches(spark, str(tmp_path / "out")).outcomes.collect()}
    assert sorted(t for _, t in first) == ["A1", "A1", "T1"] and len({i for i, _ in first}) == 3
    (tmp_path / "in" / "c.json").write_text(line("C1"))
    run()
    run()  # nothing new
    out = ingest.read_batches(spark, str(tmp_path / "out"))
    got = {(r.content_id, r.title) for r in out.outcomes.collect()}
    assert first < got and [t for _, t in got - first] == ["C1"] and len({i for i, _ in got}) == 4
    assert {i >> 44 for i, _ in got} == {0, 1, 2}
    assert [bytes(r.content).decode().count("<p>C1</p>") for r in out.fetch(["C1"]).collect()] == [1]
    bad = spark.read.parquet(f"{tmp_path}/out/quarantine").collect()
    assert [r.reason for r in bad] == ["malformed"]
