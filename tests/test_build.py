"""Files to dictionary: every kind of input, attachments, the committed write, lookups that open few files."""

import io
import json
import os
import re
import tarfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pagelex.plans import build as B
from pagelex.plans import dictionary as DI
from pagelex.plans.convert import ConvertOptions
from pagelex.sources import attachments as A
from pagelex.sources import lines as LN
from pagelex.sources import scrape as SC

from helpers import make_dims

BASE = "https://docs.example.org/enwiki"


def line(name, html, **more):
    return json.dumps({"name": name, "article_body": {"html": html}, **more})


def archive(path, mode, files):
    with tarfile.open(path, mode) as tar:
        for name, body in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(body.encode())
            tar.addfile(info, io.BytesIO(body.encode()))


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """One dictionary of a plain file, both kinds of archive and an export, with resources and a user's folder."""
    top = tmp_path_factory.mktemp("build")
    (top / "plain.json").write_text("\n".join([line("P1", '<p>one <a href="./P2#x">l</a></p>', redirects=[{"name": "Uno"}]), "{broken", line("P2", "<p>two</p>"), line("Empty", None or "")]) + "\n")
    archive(top / "a.tar", "w", {"m1": line("T1", "<p>t1</p>") + "\n", "m2": line("T2", "<p>t2</p>") + "\n" + line("T3", "<p>t3</p>") + "\n"})
    archive(top / "b.tar.gz", "w:gz", {"m1": line("Z1", "<p>z1</p>") + "\n"})
    rows = [
        {"id": "D 1", "doc": {"_id": "D 1", "aliases": ["Eins", ["P1", "frag"]], "parse": {"text": {"*": '<p><a href="/wiki/P2">x</a></p>'}, "langlinks": [{"lang": "de", "*": "D eins"}]}}},
        {"id": "D 2", "doc": None}, {"id": "D 3", "doc": {"_id": "D 3", "parse": {}}},
    ]
    (top / "export.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    for name, body in {"css/shared.css": "a", "css/mediawiki_shared.css": "b", "css/mediawiki_monobook.css": "b", "css/night.css": "n", "js/x.js": "1", "images/Globe.svg": "<svg/>",
                       "MathJax/MediaWiki.js": "m", "py/secret.py": "no", "css/readme": "no type"}.items():
        (top / "res" / os.path.dirname(name)).mkdir(parents=True, exist_ok=True)
        (top / "res" / name).write_text(body)
    (top / "own+dir (1)" / "deep").mkdir(parents=True)
    (top / "own+dir (1)" / "deep" / "Map.PNG").write_bytes(b"b")
    dims = make_dims(spark)
    names = [str(top / "plain.json"), BASE, str(top / "a.tar"), str(top / "b.tar.gz")]
    tags = DI.tags_table(spark, spark.createDataFrame([("label", "x")], "name string, value string"))
    out = B.build_dictionary(spark, names, str(top / "out"), dims, tags, ConvertOptions(rules=[]), {BASE: str(top / "export.json")},
                             B.Selection(langlinks=["de"]), str(top / "res"), [str(top / "own+dir (1)")], buckets=5)
    return top, names, dims, tags, out


def test_route():
    got = B.route(["x.json", "http://a/db", "y.tar", "https://b/db"], {"http://a/db": "a.json", "https://b/db": "b.json"})
    assert [(s.path_number, s.name, s.kind, s.path) for s in got] == [(0, "http://a/db", "export", "a.json"), (1, "https://b/db", "export", "b.json"), (2, "x.json", "dump", "x.json"), (3, "y.tar", "dump", "y.tar")]
    with pytest.raises(ValueError, match="https://b/db"):
        B.route(["https://b/db"], {})


def test_articles_of_every_source(made):
    *_, out = made
    got = {r.title: r.status for r in out.outcomes.collect()}
    # an empty page still gets the style sheets, as any text that isn't missing does
    assert got == {"P1": "S", "P2": "S", "Empty": "S", "T1": "S", "T2": "S", "T3": "S", "Z1": "S", "D 1": "S", "D 3": "E"}


def test_profiles_reach_their_articles(made):
    """The same link text is local under each source's own article path."""
    *_, out = made
    html = {r.key: bytes(r.content).decode() for r in out.fetch(["P1", "D 1"]).where("fragment is null").collect()}
    assert 'href="P2#x"' in html["P1"] and 'href="P2"' in html["D 1"]


def test_quarantine_lies_beside_the_run(spark, made):
    top, *_, out = made
    got = spark.read.parquet(f"{top}/out/{out.run}/quarantine").collect()
    assert [(os.path.basename(r.path), r.reason) for r in got] == [("plain.json", "malformed")]


def test_keys_of_both_kinds_point_at_content(made):
    *_, out = made
    keys = {(r.key, r.fragment): r.content_id for r in out.keys.collect()}
    titles = {k for k, _ in keys if not k.startswith("~/") and "/" not in k}
    assert titles == {"P1", "Uno", "P2", "Empty", "T1", "T2", "T3", "Z1", "D 1", "Eins", "D eins"} and ("P1", "frag") in keys
    files = {k: v for (k, _), v in keys.items() if "/" in k}
    assert set(files) == {"~/css/shared.css", "~/css/mediawiki_shared.css", "~/css/mediawiki_monobook.css", "~/css/night.css", "~/js/x.js", "~/images/Globe.svg", "~/MathJax/MediaWiki.js", "deep/Map.PNG"}
    assert files["~/css/mediawiki_shared.css"] == files["~/css/mediawiki_monobook.css"] == files["deep/Map.PNG"] != files["~/css/shared.css"]
    content = {r.content_id: r for r in out.content.collect()}
    assert set(keys.values()) == set(content) and len(content) == 8 + 6
    assert bytes(content[files["~/css/night.css"]].content) == b"n" and content[files["~/css/night.css"]].content_type == "text/css"


def test_every_resource_that_pages_point_at_has_a_key(made):
    *_, out = made
    assert {r.target: r.n_pages for r in DI.resource_targets(out.content).collect()} == {f"~/css/{n}.css": 8 for n in ("shared", "mediawiki_shared", "mediawiki_monobook", "night")}
    assert DI.missing_resources(out.content, out.keys).collect() == []
    less = out.keys.where("key <> '~/css/night.css'")
    assert [(r.target, r.n_pages) for r in DI.missing_resources(out.content, less).collect()] == [("~/css/night.css", 8)]


def test_no_math_leaves_the_renderer_out(spark, made):
    top, *_ = made
    got = {r.key for r in B.attachment_files(spark, str(top / "res"), None, True).collect()}
    assert "~/MathJax/MediaWiki.js" not in got and "~/js/x.js" in got
    assert B.attachment_files(spark, None, None, False) is None


def test_lookups_open_few_files(spark, made):
    top, *_, out = made
    one = out.fetch(["Z1"])
    assert [bytes(r.content).decode().count("z1") for r in one.collect()] == [1]
    plan = one._jdf.queryExecution().executedPlan().toString()
    (bucket,) = [r.bucket for r in out.keys.where("key = 'Z1'").collect()]
    scans = [x for x in plan.split("\n") if "FileScan" in x and "content_type" in x]
    assert scans and all(re.search(rf"PartitionFilters: \[[^\]]*\(bucket#\d+ = {bucket}\)", x) and "EqualTo(content_id" in x for x in scans)
    assert all("EqualTo(key,Z1)" in x for x in plan.split("\n") if "FileScan" in x and "content_type" not in x)
    assert {(r.key, r.fragment) for r in out.fetch(["P1", "none", "~/js/x.js", "P1"]).collect()} == {("P1", None), ("P1", "frag"), ("~/js/x.js", None)}
    asked = spark.createDataFrame([("Z1",), ("Uno",), ("none",)], "key string")
    hit = DI.lookup(asked, out.keys, out.content)
    assert sorted((r.key, bytes(r.content).decode().count("<p>")) for r in hit.collect()) == [("Uno", 1), ("Z1", 1)]
    # the footers of the written files hold Bloom filters and ranges
    files = sorted(str(f) for f in (top / "out" / out.run / "keys").glob("*.parquet"))
    bounds = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in files]
    assert all(x.max <= y.min for x, y in zip(bounds, bounds[1:]))


def test_a_failed_run_leaves_the_old_one(spark, made):
    top, names, dims, tags, out = made
    broken = spark.range(20).select(F.col("id").alias("article_id"), F.concat(F.lit("X"), F.col("id")).alias("title"), F.array().cast(DI.ALIASES).alias("aliases"),
                                    F.when(F.col("id") < 19, F.lit("S")).otherwise(F.raise_error(F.lit("on purpose")).cast("string")).alias("status"),
                                    F.lit(1).cast("long").alias("n_bytes"), F.encode(F.lit("x"), "utf-8").alias("content"), F.lit(None).cast("string").alias("error"))
    with pytest.raises(Exception, match="on purpose"):
        DI.write_dictionary(broken, str(top / "out"), tags)
    with pytest.raises(Exception, match="on purpose"):  # after the articles were written
        good = broken.withColumn("status", F.lit("S"))
        DI.write_dictionary(good, str(top / "out"), tags.withColumn("value", F.raise_error(F.lit("on purpose")).cast("string")))
    again = DI.read_dictionary(spark, str(top / "out"))
    assert again.run == out.run and again.content.count() == out.content.count()
    new = DI.write_dictionary(broken.withColumn("status", F.lit("S")), str(top / "out"), tags)
    assert DI.read_dictionary(spark, str(top / "out")).run == new.run != out.run and new.content.count() == 20
    assert DI.read_dictionary(spark, str(top / "out"), out.run).content.count() == out.content.count()
    assert DI.commits(spark, str(top / "out")).count() == 2


def test_ids_are_the_same_in_a_second_run_and_in_slices(spark, made):
    top, names, dims, tags, out = made
    sources = B.route(names, {BASE: str(top / "export.json")})
    ids = {r.title: r.article_id for r in B.read_inputs(spark, sources, dims).articles.collect()}
    assert {r.title: r.content_id for r in out.outcomes.collect()} == ids
    index = LN.line_index(LN.splits(spark, [s.path for s in sources if s.kind == "dump"], 40))
    some = B.read_inputs(spark, sources, dims, B.Selection("2:1", "2:1", index=index)).articles.where("kind = 'dump'").collect()
    assert {r.title: r.article_id for r in some} == {"T2": ids["T2"]}


def test_requested_keys_that_no_document_answers(spark, made):
    top, names, dims, tags, _ = made
    keys = SC.keys_from_lines(spark.createDataFrame([("D_1",), ("Not_there",)], "value string"))
    out = B.build_dictionary(spark, [BASE], str(top / "asked"), dims, tags, exports={BASE: str(top / "export.json")}, select=B.Selection(keys=keys))
    assert {(r.title, r.status) for r in out.outcomes.collect()} == {("D 1", "S"), ("Not there", "E")}
    assert out.keys.where("key = 'Not there'").count() == 0


def test_attachment_paths():
    assert A.resource_folders() == ["js", "css", "images", "MathJax"] and A.resource_folders(True) == ["js", "css", "images"]


def test_attachments_of_odd_paths(spark):
    rows = [(p, b"x") for p in ("file:/r.s/a.css", "file:///r.s/b/c.CSS", "/r.s/d.js", "/r_s/e.js", "/r.s2/f.js", "s3a://r.s/g.js", "/r.s/noend", "/r.s/h.unknown")]
    files = spark.createDataFrame(rows, "path string, content binary")
    assert sorted(r.key for r in A.attachments(files, "file:///r.s", "~/").collect()) == ["~/a.css", "~/b/c.CSS", "~/d.js", "~/g.js"]
    assert [r.key for r in A.attachments(files, "/r.s", "", ["b"]).collect()] == ["b/c.CSS"]
    assert A.attachments(files, "/r.s", "", []).collect() == []
    (blob,) = A.blobs(A.attachments(files, "/r.s")).collect()
    assert bytes(blob.content) == b"x" and blob.n_bytes == 1 and blob.content_id < 0
