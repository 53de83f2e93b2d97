"""Sources: dump lines with positions, quarantine, scraped documents, keys, site info,
rules and attachments, on files written to a temporary folder."""

import json

from pyspark.sql import functions as F

from pagelex.sources import attachments as A
from pagelex.sources import dump as D
from pagelex.sources import rules as R
from pagelex.sources import scrape as SC
from pagelex.sources import siteinfo as SI


def test_dump_positions_and_slice(spark, tmp_path):
    lines = []
    for i in range(1, 31):
        if i == 5:
            lines.append("{not json")
        elif i == 6:
            lines.append(json.dumps({"name": "N6", "article_body": {"html": "<p>6</p>"}, "redirects": None}))
        else:
            lines.append(json.dumps({"name": f"N{i}", "article_body": {"html": f"<p>{i}</p>"},
                                     **({} if i % 4 == 0 else {"redirects": [{"name": f"R{i}"}]})}))
    f = tmp_path / "dump.ndjson"
    f.write_text("\n".join(lines) + "\n")
    numbered = D.numbered_lines(spark, str(f))
    got = {r.line_number: r.value for r in numbered.collect()}
    assert sorted(got) == list(range(1, 31)) and got[7] == lines[6]
    dec = D.read_dump(spark, str(f), "1:3", "1:8")
    rows = {r.title: r for r in D.good_lines(dec).collect()}
    assert sorted(rows) == ["N3", "N4", "N7", "N8"]
    assert [a.key for a in rows["N3"].aliases] == ["R3"] and rows["N4"].aliases == []
    assert {r.reason for r in D.quarantine(dec).collect()} == {"malformed", "redirects null"}


def test_scrape_and_keys(spark, tmp_path):
    docs = [
        {"id": "A b", "doc": {"_id": "A b", "aliases": ["x", ["k", "frag"], "x"],
                              "parse": {"text": {"*": "<p>a</p>"}, "langlinks": [{"lang": "de", "*": "A de"}, {"lang": "fr", "*": "A fr"}]}}},
        {"id": "C", "doc": None},
        {"id": "D", "doc": {"_id": "D", "aliases": ["y"], "parse": {}}},
    ]
    p = tmp_path / "docs.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    arts = {r.title: r for r in SC.read_scrape_export(spark, str(p), ["de"]).collect()}
    assert sorted(arts) == ["A b", "D"]
    assert sorted((a.key, a.fragment) for a in arts["A b"].aliases) == [("A de", None), ("k", "frag"), ("x", None)]
    assert arts["D"].text is None and arts["D"].aliases == []
    keys = SC.keys_from_lines(spark.createDataFrame([(" A_b ",), ("",), ("Zz",)], "value string"))
    got = {r.title: r.found for r in SC.by_key_list(SC.read_scrape_export(spark, str(p)), keys).collect()}
    assert got == {"A b": True, "Zz": False}


def test_siteinfo_file(spark, tmp_path):
    info = {"general": {"sitename": "W", "lang": "he", "articlepath": "/wiki/$1", "server": "//he.example.org", "rtl": ""},
            "rightsinfo": {"text": "CC", "url": "//cc.org"},
            "namespaces": {"0": {"id": 0, "*": ""}, "14": {"id": 14, "canonical": "Category", "*": "Kat"},
                           "-1": {"id": -1, "canonical": "Special", "*": "Spez"}},
            "interwikimap": [{"prefix": "w", "url": "//a/$1"}, {"prefix": "w", "url": "//b/$1"}, {"prefix": "x", "url": ""}]}
    p = tmp_path / "site.json"
    p.write_text(json.dumps(info))
    dims = SI.load_dims(spark, str(p), ["Kat"])
    assert dims.site.rtl and dims.site.server == "http://he.example.org" and dims.site.articlepath == "/wiki/"
    assert sorted(r.name for r in dims.ns_lookup.collect()) == ["Special", "Spez", "special", "spez"]
    assert [(r.prefix, r.url) for r in dims.interwiki.collect()] == [("w", "//b/$1")]
    try:
        SI.load_dims(spark, str(p), ["Nope"])
        raise AssertionError("expected invalid namespace error")
    except ValueError as ex:
        assert "Nope" in str(ex)


def test_rules_and_attachments(spark, tmp_path):
    (tmp_path / "r1").write_text(".a\n\n#b\n")
    rules = R.collect_rules(R.read_rules(spark, ["r1"], str(tmp_path), adhoc=["p:empty"]))
    assert rules == [".a", "#b", "p:empty"]
    assert R.collect_rules(R.read_rules(spark, ["toc"])) == ["#toc", ".toc"]
    (tmp_path / "res" / "css").mkdir(parents=True)
    (tmp_path / "res" / "js").mkdir()
    (tmp_path / "res" / "css" / "a.css").write_text("x{}")
    (tmp_path / "res" / "js" / "b.js").write_text("1")
    got = {r.key: r.n_bytes for r in A.read_attachments(spark, str(tmp_path / "res"), "~/", ["css"]).collect()}
    assert got == {"~/css/a.css": 3}


def test_lines_and_documents_are_parsed_once(spark):
    """A filter on what was decoded does not parse again, whatever is read of it."""
    lines = spark.range(3).select(F.col("id").cast("string").alias("value"))
    articles = SC.decode_scrape_rows(lines, ["de"])
    for df in (D.good_lines(D.decode_dump_lines(lines)), D.quarantine(D.decode_dump_lines(lines)), SC.key_range(articles, "a").select("title", "text")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
