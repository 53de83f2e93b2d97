"""Macro expansion against a plain recursive reader."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pagelex.functions import tex as TX

TOKEN = re.compile(r"\\[A-Za-z]+|\\.|\\$|[{}]|\s+|[^\\{}\s]+", re.S)


def group(t, i):
    """The place of the brace that closes the one at i, or None."""
    depth = 0
    for j in range(i, len(t)):
        depth += {"{": 1, "}": -1}.get(t[j], 0)
        if not depth:
            return j
    return None


def plain(t, table):
    """Recursive: expansions of the tokens t."""
    out, i = "", 0
    while i < len(t):
        x = t[i]
        name = x[1:] if x.startswith("\\") else None
        text, n = table.get(name, (None, 0))
        if text is None:
            out += x
        elif n == 0:
            out += text
        else:
            j = i + 1
            while j < len(t) and t[j].isspace():
                j += 1
            if j == len(t) or t[j] == "}":
                out += x
            elif t[j] == "{":
                end = group(t, j)
                if end is None:
                    out += x + "{"
                    i = j
                else:
                    out += text.replace("#1", plain(t[j + 1 : end], table))
                    i = end
            elif t[j].startswith("\\"):
                inner, args = table.get(t[j][1:], (t[j], 0))
                out += text.replace("#1", t[j] if args else inner)
                i = j
            else:
                out += text.replace("#1", t[j][0])
                t = [*t[: j + 1], *([t[j][1:]] if len(t[j]) > 1 else []), *t[j + 1 :]]
                i = j
        i += 1
    return out


def run(spark, texts, macros=None):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, tex string")
    return [r.out for r in df.select("i", TX.expand(F.col("tex"), macros).alias("out")).orderBy("i").collect()]


def test_expansion_by_hand(spark):
    cases = {
        r"\R^2": r"\mathbb{R}^2", r"x\in\R": r"x\in\mathbb{R}", r"\bold{x_{1}}y": r"\mathbf{x_{1}}y", r"\bold  xy": r"\mathbf{x}y",
        r"\bold{\bold{\R}}": r"\mathbf{\mathbf{\mathbb{R}}}", r"\bold\R": r"\mathbf{\mathbb{R}}", r"\pagecolor{red}a": "a", r"\bold": r"\bold", r"{\bold}": r"{\bold}",
        r"\bold{a": r"\bold{a", r"\P \sect": r"\P \S", r"\Reals\\R": r"\mathbb{R}\\R", r"\Rx": r"\Rx", r"\{\R\}": r"\{\mathbb{R}\}", "": "", r"a\\": r"a\\", r"\bold{a}{b}": r"\mathbf{a}{b}",
        r"\bold \bold{x}": r"\mathbf{\bold}{x}",
    }
    assert run(spark, list(cases)) == list(cases.values())
    assert run(spark, [None]) == [None]


def test_expansion_of_random_sources(spark):
    rng = random.Random(1)
    words = ["\\bold", "\\pagecolor", "\\R", "\\alpha", "\\infin", "{", "}", "{", "}", " ", "xy", "1", "\\,", "\\{", "\n", "\\P", "é"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(400)]
    table = TX.closed_macros()
    assert run(spark, texts) == [plain(TOKEN.findall(t), table) for t in texts]


def test_chains_and_cycles(spark):
    macros = [("a", r"\b+\b", 0), ("b", r"\c", 0), ("c", "z", 0), ("p", r"\q", 0), ("q", r"x\p", 0), ("r", r"\p!", 0), ("f", r"<#1\c#1>", 1)]
    assert TX.closed_macros(macros) == {"a": ("z+z", 0), "b": ("z", 0), "c": ("z", 0), "r": (r"\p!", 0), "f": ("<#1z#1>", 1)}
    assert run(spark, [r"\a \p \r \f{\a}"], macros) == [r"z+z \p \p! <z+zzz+z>"]
    with pytest.raises(ValueError):
        TX.closed_macros([("g", "#1#2", 2)])
