"""Selector rules, rebuilt parents and styles against plain Python on random trees."""

import random

import pytest
from pyspark.sql import functions as F

from pagelex.operators import clean as C
from pagelex.operators import nodes as N
from pagelex.operators import selectors as S


class El:
    def __init__(self, tag, cls, up):
        self.tag, self.cls, self.up, self.kids, self.n = tag, cls, up, [], None


def tree(rng, depth=0, up=None):
    e = El(rng.choice("abi"), rng.choice(["", "x", "y", "x y"]), up)
    for _ in range(rng.randrange(4) if depth < 5 else 0):
        e.kids.append(rng.choice(["t", None]) or tree(rng, depth + 1, e))
    return e


def write(e, number):
    if isinstance(e, str):
        return e
    e.n = number[0] = number[0] + 1
    inner = "".join(write(k, number) for k in e.kids)
    return f'<{e.tag} class="{e.cls}" id="n{e.n}">{inner}</{e.tag}>'


def walk(e):
    yield e
    for k in e.kids:
        if isinstance(k, El):
            yield from walk(k)


def ok(e, c):
    """A compound: tag, classes, whether it must be empty."""
    return (not c[0] or e.tag == c[0]) and all(k in e.cls.split() for k in c[1]) and (not c[2] or not e.kids)


def matches(e, steps):
    """steps: (combinator before it, compound), the subject last."""
    (comb, c), rest = steps[-1], steps[:-1]
    if not ok(e, c):
        return False
    if not rest:
        return True
    up = e.up
    while up is not None and up.up is not None:  # the document itself is no element
        if matches(up, rest):
            return True
        if comb == ">":
            return False
        up = up.up
    return False


def selector(rng):
    steps = []
    for i in range(rng.randrange(1, 5)):
        steps.append((rng.choice([">", " "]), (rng.choice(["", "a", "b", "i"]), rng.choice([(), ("x",), ("y",), ("x", "y")]), False)))
    if rng.random() < 0.25:
        steps[-1] = (steps[-1][0], (*steps[-1][1][:2], True))
    text = ""
    for i, (comb, (tag, cls, empty)) in enumerate(steps):
        text += ("" if not i else rng.choice([" > ", ">"]) if comb == ">" else " ") + (tag or "*") + "".join("." + k for k in cls) + (":empty" if empty else "")
    return text, steps


def applied(root, rules):
    for alternatives in rules:
        gone = [e for e in walk(root) if e.up is not None and any(matches(e, steps) for _, steps in alternatives)]
        for e in gone:
            if e in e.up.kids:
                e.up.kids.remove(e)
    return [e.n for e in walk(root)][1:]


@pytest.mark.parametrize("seed", range(6))
def test_rules_on_random_trees(spark, seed):
    """Chains of child and descendant steps, comma lists and :empty, in order, on trees six deep."""
    rng = random.Random(seed)
    rules = [[selector(rng) for _ in range(rng.randrange(1, 4))] for _ in range(3)]
    texts, want = [], []
    for i in range(60):
        root = El("", "", None)
        root.kids = [tree(rng, 0, root) for _ in range(rng.randrange(1, 4))]
        texts.append((i, "".join(write(k, n) for n in [[0]] for k in root.kids)))
        want.append((i, applied(root, rules)))
    nodes = C.apply_rules(N.tokenize(spark.createDataFrame(texts, "article_id long, text string").repartition(3)), [", ".join(t for t, _ in r) for r in rules])
    rows = nodes.where("kind = 'open'").select("article_id", F.col("attrs")["id"].substr(2, 9).cast("int").alias("n")).collect()
    got = {i: [] for i, _ in texts}
    for r in rows:
        got[r.article_id].append(r.n)
    assert [(i, sorted(got[i])) for i, _ in texts] == [(i, sorted(x)) for i, x in want]


def test_parents_after_unwraps_on_random_trees(spark):
    rng = random.Random(9)
    texts, want = [], {}
    for i in range(60):
        root = tree(rng)
        texts.append((i, write(root, [0])))
        for e in walk(root):
            if e.tag != "b":
                up, depth = e.up, 0
                while up is not None and up.tag == "b":
                    up = up.up
                x = e.up
                while x is not None:
                    depth += x.tag != "b"
                    x = x.up
                want[i, e.n] = (up.n if up else None, up.tag if up else None, up.cls if up else None, depth)
    nodes = N.tokenize(spark.createDataFrame(texts, "article_id long, text string"))
    nodes = N.rebuild_parents(nodes.where("tag is null or tag <> 'b'"))
    rows = nodes.where("kind = 'open'").select("article_id", "pos", "parent_pos", "ptag", "pclass", "depth", "pclose", "close_pos", F.col("attrs")["id"].substr(2, 9).cast("int").alias("n")).collect()
    at = {(r.article_id, r.pos): r for r in rows}
    got = {}
    for r in rows:
        up = at.get((r.article_id, r.parent_pos))
        assert (up is None) == (r.parent_pos == -1) and (up is None or up.close_pos == r.pclose)
        got[r.article_id, r.n] = (up.n if up else None, r.ptag, r.pclass, r.depth)
    assert got == want
    assert nodes.columns == N.tokenize(spark.createDataFrame(texts, "article_id long, text string")).columns


def test_child_chains_parse():
    assert [c for c, _ in S.parse_selector("div.a > b > i").chain] == [">", ">"]
    assert [len(g) for g in S.parse_groups(["p:empty, div:empty", "a[href='x,y']", " , "])] == [2, 1]
    assert [len(p) for p in S.plan_passes(S.parse_groups([".a", ".b, p:empty", ".c", "i:empty"]))] == [1, 3, 1]


@pytest.mark.parametrize("style,names", [
    ("a:1;b:2", ["a", "b"]), ("", []), (";;", []), ("a:'x;y';b:(;)", ["a", "b"]), ("a:((((((1;2))))));b:1", ["a", "b"]), ("a:\\;b;c:1", ["a", "c"]), ("/*;*/A/**/ : 1", ["a"]),
    ("a:'x", None), ("a:(x", None), ("a:x)", None), ("a:{x}", None), ("a:1/*", None), ("a:\\", None), ("a:]", None), ("a:1/2;b:/;c://x", ["a", "b", "c"]),
    ("x" * 50_000 + ":1;" + "(" * 200, None), ("a:" + "'\"'" * 5000 + ";b:" + "(" * 3 + "x" * 50_000 + ")" * 3, ["a", "b"]),
])
def test_style_declarations(spark, style, names):
    (got,) = spark.createDataFrame([(style,)], "s string").select(C.style_declarations(F.col("s")).alias("d")).collect()
    assert (None if got.d is None else [x.name for x in got.d]) == names
