"""CSS selector rules compiled to boolean Columns over node rows (UDF-1, DOC-3).

Supported grammar (anything else is rejected when the rule is compiled, before any job):

    selector-list := selector ("," selector)*
    selector      := compound (combinator compound)*      combinator := ">" | whitespace
    compound      := [tag | "*"] ( "#id" | ".class" | "[a]" | "[a=v]" | "[a^=v]" | "[a*=v]"
                      | "[a$=v]" | "[a~=v]" | "[a|=v]" | ":empty" | ":not(compound)"
                      | ":contains('text')" )*

Evaluation on the node table:

* a compound is a row-local predicate on (tag, attrs) of an ``open`` row;
* ``A > B`` alone, with a tag and classes only in A, uses the parent fields ``ptag`` / ``pclass`` that the
  tokenizer emits;
* any other ``A > B`` takes from the parent's row whether the chain up to A matches there (``nodes.of_parent``: one
  window by parent for all selectors of a pass), so chains of any depth and kind are exact;
* a descendant step ``A B`` is "some ancestor matches the chain up to A": a running max over the close
  positions of those rows (one window column per step, all on the article window);
* ``:empty`` needs the next row (``lead``); ``:contains`` needs a forward search over the
  article's text rows, done with a descending-order window.  Both are *structural*: they
  depend on earlier drops, so rules using them get their own pass; the alternatives of one rule
  (a comma list) see the same tree.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import nodes as N


class SelectorError(ValueError):
    pass


@dataclass
class Compound:
    tag: str | None = None
    ids: list[str] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    attrs: list[tuple[str, str | None, str | None]] = field(default_factory=list)  # (name, op, value)
    nots: list["Compound"] = field(default_factory=list)
    empty: bool = False
    contains: list[str] = field(default_factory=list)

    @property
    def structural(self) -> bool:
        return self.empty or bool(self.contains) or any(n.structural for n in self.nots)

    @property
    def parent_safe(self) -> bool:
        return not (self.ids or self.attrs or self.nots or self.empty or self.contains)


@dataclass
class Selector:
    text: str
    subject: Compound
    chain: list[tuple[str, Compound]]  # (combinator, compound), nearest ancestor first

    @property
    def structural(self) -> bool:
        return self.subject.structural or any(c.structural for _, c in self.chain)


_IDENT = r"-?[_a-zA-Z\u00a0-\uffff][_a-zA-Z0-9\u00a0-\uffff-]*"
_TOKEN = re.compile(
    r"\s*(?P<comb>>)\s*|(?P<ws>\s+)|(?P<star>\*)|(?P<tag>" + _IDENT + r")|#(?P<id>" + _IDENT + r")"
    r"|\.(?P<cls>" + _IDENT + r")"
    r"|\[\s*(?P<an>" + _IDENT + r")\s*(?:(?P<op>[\^*$~|]?=)\s*(?P<av>\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]"
    r"|:(?P<pseudo>empty)\b|:not\((?P<not>[^()]*)\)|:contains\(\s*(?P<cont>\"[^\"]*\"|'[^']*'|[^)]*?)\s*\)"
)


def _unquote(v: str) -> str:
    if len(v) >= 2 and v[0] == v[-1] and v[0] in "'\"":
        return v[1:-1]
    return v


def _parse_compound_tokens(text: str, pos: int, stop_at_ws: bool = True):
    c = Compound()
    seen = False
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m or m.group("comb") is not None or m.group("ws") is not None:
            break
        pos = m.end()
        seen = True
        if m.group("star"):
            continue
        if m.group("tag"):
            if c.tag is not None:
                raise SelectorError(f"unsupported selector: {text!r}")
            c.tag = m.group("tag").lower()
        elif m.group("id"):
            c.ids.append(m.group("id"))
        elif m.group("cls"):
            c.classes.append(m.group("cls"))
        elif m.group("an"):
            op = m.group("op")
            c.attrs.append((m.group("an").lower(), op, _unquote(m.group("av")) if op else None))
        elif m.group("pseudo"):
            c.empty = True
        elif m.group("not") is not None:
            inner, end = _parse_compound_tokens(m.group("not").strip(), 0)
            if end != len(m.group("not").strip()):
                raise SelectorError(f"unsupported :not() argument in {text!r}")
            c.nots.append(inner)
        elif m.group("cont") is not None:
            c.contains.append(_unquote(m.group("cont")))
    if not seen:
        raise SelectorError(f"unsupported selector: {text!r}")
    return c, pos


def parse_selector(text: str) -> Selector:
    s = text.strip()
    compounds: list[Compound] = []
    combs: list[str] = []
    pos = 0
    while True:
        c, pos = _parse_compound_tokens(s, pos)
        compounds.append(c)
        if pos >= len(s):
            break
        m = _TOKEN.match(s, pos)
        if m and m.group("comb") is not None:
            combs.append(">")
        elif m and m.group("ws") is not None:
            nxt = _TOKEN.match(s, m.end())
            if nxt and nxt.group("comb") is not None:
                combs.append(">")
                m = nxt
            else:
                combs.append(" ")
        else:
            raise SelectorError(f"unsupported selector syntax at {s[pos:]!r} in {text!r}")
        pos = m.end()
    subject = compounds[-1]
    chain = [(combs[i], compounds[i]) for i in range(len(compounds) - 2, -1, -1)]
    for comb, c in chain:
        if c.structural:
            raise SelectorError(f":empty/:contains only on the subject: {text!r}")
    return Selector(text, subject, chain)


def parse_groups(rules: list[str]) -> list[list[Selector]]:
    """The alternatives of each rule (a comma list), in rule order."""
    groups = [[parse_selector(part) for part in _split_commas(r) if part.strip()] for r in rules]
    return [g for g in groups if g]


def parse_rules(rules: list[str]) -> list[Selector]:
    """All alternatives of all rules, in order."""
    return [s for g in parse_groups(rules) for s in g]


def _split_commas(s: str) -> list[str]:
    parts, depth, cur, quote = [], 0, [], None
    for ch in s:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append("".join(cur))
            cur = []
            continue
        cur.append(ch)
    parts.append("".join(cur))
    return parts


# --------------------------------------------------------------------------- compile


def _classes(cls_col: Column) -> Column:
    return F.split(F.trim(F.coalesce(cls_col, F.lit(""))), r"\s+")


def compound_pred(c: Compound, tag: Column, attrs: Column, cls: Column | None = None,
                  struct_cols: dict | None = None) -> Column:
    """Row-local predicate of one compound on (tag, attrs)."""
    conds = [F.lit(True)]
    if c.tag:
        conds.append(tag == c.tag)
    classes = _classes(cls if cls is not None else attrs["class"])
    for k in c.classes:
        conds.append(F.array_contains(classes, k))
    for i in c.ids:
        conds.append(attrs["id"] == i)
    for name, op, val in c.attrs:
        a = attrs[name]
        if op is None:
            conds.append(F.map_contains_key(attrs, name))
        elif op == "=":
            conds.append(a == val)
        elif op == "^=":
            conds.append(F.lit(bool(val)) & F.startswith(a, F.lit(val)))
        elif op == "*=":
            conds.append(F.lit(bool(val)) & F.contains(a, F.lit(val)))
        elif op == "$=":
            conds.append(F.lit(bool(val)) & F.endswith(a, F.lit(val)))
        elif op == "~=":
            conds.append(F.array_contains(_classes(a), val))
        elif op == "|=":
            conds.append((a == val) | F.startswith(a, F.lit(val + "-")))
    for n in c.nots:
        conds.append(~F.coalesce(compound_pred(n, tag, attrs, None, struct_cols), F.lit(False)))
    if c.empty:
        conds.append(F.col("__empty"))
    for t in c.contains:
        conds.append(F.col((struct_cols or {})[t]))
    out = conds[0]
    for x in conds[1:]:
        out = out & x
    return F.coalesce(out, F.lit(False))


def _node_pred(c: Compound, struct_cols=None) -> Column:
    return (F.col("kind") == "open") & compound_pred(c, F.col("tag"), F.col("attrs"), None, struct_cols)


def with_structure(nodes: DataFrame, sels: list[Selector]) -> tuple[DataFrame, dict]:
    """Add the structural helper columns the selectors need (``__empty``, ``__cont_i``)."""
    struct_cols: dict[str, str] = {}
    needs_empty = any(_uses(s, "empty") for s in sels)
    texts = sorted({t for s in sels for t in _contains_texts(s)})
    w = N.article_window()
    if needs_empty:
        nxt = F.lead("pos").over(w)
        nodes = nodes.withColumn("__empty", (F.col("kind") == "open") & (nxt.isNull() | (nxt > F.col("close_pos"))))
    if texts:
        wdesc = Window.partitionBy("article_id").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
        for i, t in enumerate(texts):
            name = f"__cont_{i}"
            struct_cols[t] = name
            nxt_hit = F.min(F.when((F.col("kind") == "text") & F.contains(F.col("text"), F.lit(t)), F.col("pos"))).over(wdesc)
            nodes = nodes.withColumn(name, F.coalesce(nxt_hit <= F.col("close_pos"), F.lit(False)))
    return nodes, struct_cols


def _uses(s: Selector, what: str) -> bool:
    def walk(c: Compound):
        return c.empty or any(walk(n) for n in c.nots)
    return walk(s.subject)


def _contains_texts(s: Selector):
    def walk(c: Compound):
        yield from c.contains
        for n in c.nots:
            yield from walk(n)
    yield from walk(s.subject)


def hits(nodes: DataFrame, sels: list[Selector], out_col: str = "__hit") -> DataFrame:
    """``out_col`` = some selector matches the row (open rows only).

    All selectors are evaluated side by side, each from its farthest step towards the subject: ``m`` says where the chain so far
    matches. Descendant steps are one ancestor-flag window column each; the child steps that are due at one time share one
    window by parent. All windows are on the article's partitioning, so no exchange is planned.
    """
    nodes, struct_cols = with_structure(nodes, sels)
    tmp: list[str] = []

    def keep(name: str, value: Column) -> Column:
        nonlocal nodes
        nodes = nodes.withColumn(name, value)
        tmp.append(name)
        return F.col(name)

    done: dict[int, Column] = {}
    open_: dict[int, tuple[Column, list[tuple[str, Compound]]]] = {}
    for i, s in enumerate(sels):
        local = _local(s, struct_cols)
        if local is not None:
            done[i] = local
            continue
        (_, far), left = s.chain[-1], [(s.chain[k][0], s.chain[k - 1][1] if k else s.subject) for k in range(len(s.chain) - 1, -1, -1)]
        open_[i] = keep(f"__m_{i}", _node_pred(far, struct_cols)), left
    step = 0
    while open_:
        step += 1
        for i, (m, left) in list(open_.items()):
            while left and left[0][0] != ">":
                around = keep(f"__anc_{i}_{len(left)}", N.has_enclosing(m))
                m = keep(f"__m_{i}_{len(left)}", _node_pred(left[0][1], struct_cols) & around)
                left = left[1:]
            open_[i] = m, left
            if not left:
                done[i] = open_.pop(i)[0]
        if open_:
            nodes = N.of_parent(nodes, {f"__up_{step}_{i}": m for i, (m, _) in open_.items()})
            tmp += [f"__up_{step}_{i}" for i in open_]
            for i, (_, left) in list(open_.items()):
                below = _node_pred(left[0][1], struct_cols) & F.coalesce(F.col(f"__up_{step}_{i}"), F.lit(False))
                open_[i] = keep(f"__c_{i}_{len(left)}", below), left[1:]
    hit = F.lit(False)
    for i in range(len(sels)):
        hit = hit | done[i]
    nodes = nodes.withColumn(out_col, hit)
    drop = tmp + [c for c in ("__empty",) if c in nodes.columns] + list(struct_cols.values())
    return nodes.drop(*drop)


def _local(s: Selector, struct_cols=None) -> Column | None:
    """The selector as a Column of the row alone (and its structural columns); None if it needs other rows."""
    if not s.chain:
        return _node_pred(s.subject, struct_cols)
    if len(s.chain) == 1 and s.chain[0][0] == ">" and s.chain[0][1].parent_safe:
        return _node_pred(s.subject, struct_cols) & compound_pred(s.chain[0][1], F.col("ptag"), F.create_map(), F.col("pclass"))
    return None


def row_local_pred(sels: list[Selector]) -> Column | None:
    """One Column for selectors that need no other row; ``None`` when some selector does."""
    preds = [None if s.structural else _local(s) for s in sels]
    if any(p is None for p in preds):
        return None
    out = F.lit(False)
    for p in preds:
        out = out | p
    return out


def plan_passes(groups: list[list[Selector]]) -> list[list[Selector]]:
    """Rules (each a list of alternatives) in passes, so that each structural rule sees all earlier drops.

    A pass is: [structural rule] + the non-structural rules after it (those do not depend on
    the tree state, and the structural rule must not see them yet).  Leading non-structural
    rules form the first pass. The alternatives of a rule always share a pass.
    """
    passes: list[list[Selector]] = []
    cur: list[Selector] = []
    for alternatives in groups:
        if any(s.structural for s in alternatives) and cur:
            passes.append(cur)
            cur = []
        cur = cur + alternatives
    if cur:
        passes.append(cur)
    return passes
