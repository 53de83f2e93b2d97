"""Selector-rule source (SRC-7) and the bundled rule sets.

Rule files hold one CSS selector per line; blank lines are dropped; ad-hoc selectors are
appended after the files, in order.  Rules are configuration sized: they are collected
once and compiled to a single Column per pass (``operators.selectors``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The bundled rule sets, by name, in file order.
BUNDLED = {
    "common": [
        "#calendar", "#catlinks", "#commonscat", "#commonsinfopict", "#commonslink", "#footer",
        "#header", "#interProject", "#mw-mf-language-section", "#mw-mf-last-modified",
        "#mw-mf-page-left", "#page-actions", "#sisterproject", "#siteNotice", ".autocollapse",
        ".catlinks", ".cmbox", ".collapsible", ".edit-page", ".fmbox", ".header", ".interProject",
        ".magnify", ".maptable", ".mediaContainer", ".metadata", ".mw-editsection", ".editsection",
        ".navbar", ".navbox", ".navigation-box", ".notice", ".ombox", ".portal", ".printonly",
        ".request-box", ".section_anchors", ".sister-project", ".sisterproject", ".stub", ".tmbox",
        ".vertical-navbox", "div:empty", "p:empty", "script", "style", "#persondata", ".mbox-image",
        ".mbox-text", ".geo-multi-punct", "a.mw-headline-anchor", ".mwe-math-mathml-inline",
        ".nomobile", ".mw-collapsible.mw-collapsed", "#coordinates",
    ],
    "image": ["img:not(.tex)", ".thumb", ".thumbcaption", ".thumbinner"],
    "infobox": [".infobox"],
    "reflist": [".reflist", ".refbegin", "#References", "h2:empty", 'a[href^="#cite"]'],
    "toc": ["#toc", ".toc"],
    "wiki": [".NavContent", ".NavFrame", ".NavHead"],
    "wikt": [".floatright", ".plainlinksneverexpand", ".checktrans"],
}


def read_rules(spark: SparkSession, names: list[str] | None = None, rule_dir: str | None = None,
               adhoc: list[str] | None = None) -> DataFrame:
    """rules(rule_id, source, selector): bundled sets or files of ``rule_dir``, then ad hoc."""
    parts = []
    for i, name in enumerate(names or []):
        if rule_dir:
            path = os.path.join(os.path.expanduser(rule_dir), name)
            df = spark.read.text(path).select(F.lit(i).alias("file_pos"), F.lit(name).alias("source"),
                                              F.monotonically_increasing_id().alias("line_pos"),
                                              F.trim("value").alias("selector"))
        else:
            rows = [(i, name, j, s) for j, s in enumerate(BUNDLED[name])]
            df = spark.createDataFrame(rows, "file_pos int, source string, line_pos long, selector string")
        parts.append(df)
    n = len(parts)
    rows = [(n, "adhoc", j, s) for j, s in enumerate(adhoc or [])]
    parts.append(spark.createDataFrame(rows, "file_pos int, source string, line_pos long, selector string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("selector") != "")


def collect_rules(rules: DataFrame) -> list[str]:
    """Rules in order (file, then line), for compiling."""
    return [r.selector for r in rules.orderBy("file_pos", "line_pos").select("selector").collect()]
