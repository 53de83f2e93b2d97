"""The node table: tokenize (DOC-1), serialise (DOC-16 / AGG-5) and subtree windows (WIN-3).

``tokenize`` is the one Python step of the library: a ``mapInArrow`` over article batches
that scans plain markup by one regular expression (other markup by the stdlib
``html.parser``) with an open-element stack and emits one row per token.  Tree repair follows the Python-parser soup model: void elements never nest,
an end tag closes back to the most recent open element of that name (closing the ones
opened after it), a stray end tag is ignored, and everything still open is closed at the
end.  There are no implied end tags (``<p><p>`` nests).

Node rows (no separate close rows: an element is its open row plus ``close_pos``)::

    article_id long, pos long, kind string (doc|open|text|comment|doctype|pi|error),
    tag string, attrs map<string,string>, text string, close_pos long, parent_pos long,
    depth int, ptag string, pclass string, raw boolean, pclose long (parent's close_pos),
    <carried article columns>

``pos`` is 16 x the token's document sequence number, so up to 15 tokens can be inserted
after any token without renumbering; ``[pos, close_pos]`` is the element's subtree
interval, so "inside X" is interval containment, evaluated with running-max windows.
The ``doc`` row (pos -16) is the article's own row: it carries the article columns
through the single ``article_id`` exchange.
"""

from __future__ import annotations

import html
import html.parser
import itertools
import re
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = 16
OUT_BYTES = 4 << 20
TASK_CHARS = 2 << 20

# HTML void elements of the soup parser model (never have children).
VOID_TAGS = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
))
RAW_TEXT_TAGS = frozenset(("script", "style"))

NODE_FIELDS = [
    ("pos", T.LongType()), ("kind", T.StringType()), ("tag", T.StringType()),
    ("attrs", T.MapType(T.StringType(), T.StringType())), ("text", T.StringType()),
    ("close_pos", T.LongType()), ("parent_pos", T.LongType()), ("depth", T.IntegerType()),
    ("ptag", T.StringType()), ("pclass", T.StringType()), ("raw", T.BooleanType()),
    ("pclose", T.LongType()),
]


# What the scanner reads itself: markup on which every version of the stdlib parser agrees. From the first token of another
# form on (unquoted values, stray "<", open quotes or comments, ...) a document is read by the stdlib parser.
_SPACE = r"[ \t\n\r\f]"
_TOKEN = re.compile(
    rf"""([^<]+)
    |<([a-zA-Z][a-zA-Z0-9:_-]*)((?:{_SPACE}+[a-zA-Z_:][a-zA-Z0-9_:.-]*(?:=(?:"[^"]*"|'[^']*'))?)*){_SPACE}*(/?)>
    |</([a-zA-Z][a-zA-Z0-9:_-]*){_SPACE}*>
    |<!--(?![->])((?:[^-]|-(?!-))*)-->
    |<!([dD][oO][cC][tT][yY][pP][eE][^>]*)>""".replace("\n    ", ""),
)
_ATTR = re.compile(rf"""{_SPACE}+([^ \t\n\r\f=]+)(?:=(?:"([^"]*)"|'([^']*)'))?""")
_RAW_END = {t: re.compile(rf"</\s*{t}", re.I) for t in RAW_TEXT_TAGS}
_OTHER_MODE = (frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS) | frozenset(getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ())) | {"plaintext"}) - RAW_TEXT_TAGS
_unescape_attr = getattr(html.parser, "_unescape_attrvalue", html.unescape)

_KINDS = ("doc", "open", "text", "comment", "doctype", "pi", "error", "text")
_DOC, _OPEN, _TEXT, _COMMENT, _DOCTYPE, _PI, _ERROR, _RAW = range(8)  # _RAW: text that is not escaped
_TEXTS = (_TEXT, _RAW)


class _Tokenizer(HTMLParser):
    """Token rows of documents, one after another, a tuple each: (pos, kind, tag, text, parent, depth, class, where its attributes begin or None).
    ``close_pos`` is a list beside them, as it is known later; parents are row numbers, so that a parent's columns are taken at the end."""

    def __init__(self, keep_tags: frozenset[str] | None = None):
        super().__init__(convert_charrefs=True)
        self.keep_tags = keep_tags
        self.rows: list[tuple] = []
        self.close_pos: list[int] = []
        self.keys: list[str] = []
        self.values: list[str] = []
        self._start()

    def _start(self):
        self.parents: list[int] = []  # rows of the open elements that have one
        self.tags: list[str] = []  # of all open elements
        self.opened: list[int | None] = []  # their rows or None
        self.seq = 0

    def _row(self, kind, tag=None, text=None, attrs=None, cls=None):
        pos, parents = self.seq * STEP, self.parents
        self.seq += 1
        self.rows.append((pos, kind, tag, text, parents[-1] if parents else None, len(parents), cls, attrs))
        self.close_pos.append(pos)

    def _single(self, kind, at, depth, text=None):
        """A row beside the tree."""
        self.rows.append((at, kind, None, text, None, depth, None, None))
        self.close_pos.append(at)

    def document(self, html_text: str | None):
        """The rows of one document: its own row and its tokens, or an error row (failure isolation per article, never a failed task)."""
        self._start()
        self._single(_DOC, -STEP, -1)
        rows, attrs = len(self.rows), len(self.keys)
        try:
            at = self._scan(html_text)
            if at < len(html_text):
                self.reset()
                self.feed(html_text[at:])
                self.close()
            while self.tags:
                self._close()
        except Exception as ex:
            del self.rows[rows:], self.close_pos[rows:], self.keys[attrs:], self.values[attrs:]
            self._single(_ERROR, 0, 0, f"{type(ex).__name__}: {ex}" or "error")

    def _scan(self, s: str) -> int:
        """Reads plain tokens up to the returned place, which is the end or a token for the stdlib parser.

        What is most frequent (text, tags and their attributes) is done in the loop itself: a call for each token costs as much as the rest."""
        at, n = 0, len(s)
        rows, close_pos, keys, values = self.rows, self.close_pos, self.keys, self.values
        parents, tags, opened, keep = self.parents, self.tags, self.opened, self.keep_tags
        unescape, add = html.unescape, rows.append
        while at < n:
            begin = at
            for m in _TOKEN.finditer(s, at):
                if m.start() != at:
                    return at
                what = m.lastindex
                if what == 1:
                    text = m[1]
                    if "&" in text:
                        text = unescape(text)
                    pos, last = self.seq * STEP, rows[-1]
                    if not text or last[0] + STEP == pos and last[1] in _TEXTS:
                        self.handle_data(text)
                    else:
                        add((pos, _TEXT, None, text, parents[-1] if parents else None, len(parents), None, None))
                        close_pos.append(pos)
                        self.seq += 1
                elif what == 5:
                    self.handle_endtag(m[5].lower())
                elif what == 4:
                    tag = m[2].lower()
                    if tag in RAW_TEXT_TAGS:
                        end = None if m[4] else _RAW_END[tag].search(s, m.end())
                        if end is None or not s.startswith(">", end.end()) or end.end() - end.start() != len(tag) + 2 or "<!--" in s[m.end():end.start()]:
                            return at
                    elif tag in _OTHER_MODE:
                        return at
                    if keep is None or tag in keep:
                        cls, first = None, len(keys)
                        if m[3]:
                            amap: dict[str, str] = {}
                            for k, v, w in _ATTR.findall(m[3]):
                                k = k.lower()
                                if k not in amap:
                                    v = v or w
                                    amap[k] = _unescape_attr(v) if "&" in v else v
                            cls = amap.get("class")
                            keys.extend(amap)
                            values.extend(amap.values())
                        pos = self.seq * STEP
                        self.seq += 1
                        add((pos, _OPEN, tag, None, parents[-1] if parents else None, len(parents), cls, first))
                        close_pos.append(pos)
                        row = len(close_pos) - 1
                    else:  # its children are its parent's
                        row = None
                    if tag not in VOID_TAGS:
                        tags.append(tag)
                        opened.append(row)
                        if row is not None:
                            parents.append(row)
                        if m[4]:
                            self._close()
                    if tag in RAW_TEXT_TAGS:
                        self.handle_data(s[m.end():end.start()])
                        self.handle_endtag(tag)
                        at = end.end() + 1
                        break
                elif what == 6:
                    self._row(_COMMENT, None, m[6])
                else:
                    self._row(_DOCTYPE, None, m[7])
                at = m.end()
            if at == begin:
                return at
        return at

    def handle_starttag(self, tag, attrs):
        row = None
        if self.keep_tags is None or tag in self.keep_tags:  # else its children are its parent's
            amap: dict[str, str] = {}
            for k, v in attrs:
                if k not in amap:
                    amap[k] = "" if v is None else v
            first = len(self.keys)
            self.keys.extend(amap)
            self.values.extend(amap.values())
            self._row(_OPEN, tag, None, first, amap.get("class"))
            row = len(self.rows) - 1
        if tag not in VOID_TAGS:
            self.tags.append(tag)
            self.opened.append(row)
            if row is not None:
                self.parents.append(row)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        tags = self.tags
        if tags and tags[-1] == tag:
            self._close()
        elif tag in tags:
            while tags[-1] != tag:
                self._close()
            self._close()

    def _close(self):
        self.tags.pop()
        row = self.opened.pop()
        if row is not None:
            self.parents.pop()
            self.close_pos[row] = self.seq * STEP
            self.seq += 1

    def handle_data(self, data):
        if not data:
            return
        last, parents = self.rows[-1], self.parents
        if last[1] in _TEXTS and self.seq * STEP == last[0] + STEP and last[4] == (parents[-1] if parents else None):
            self.rows[-1] = (*last[:3], last[3] + data, *last[4:])
            return
        self._row(_RAW if self.tags and self.tags[-1] in RAW_TEXT_TAGS else _TEXT, None, data)

    def handle_comment(self, data):
        self._row(_COMMENT, None, data)

    def handle_decl(self, decl):
        self._row(_DOCTYPE, None, decl)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.handle_data(data[6:])
        else:
            self._row(_DOCTYPE, None, data)

    def handle_pi(self, data):
        self._row(_PI, None, data)

    def columns(self) -> list[pa.Array]:
        """The rows so far as Arrow columns in the order of ``NODE_FIELDS``."""
        pos, kind, tag, text, parent, depth, cls, starts = zip(*self.rows) if self.rows else ((),) * 8
        pos, tag, close_pos = pa.array(pos, pa.int64()), pa.array(tag, pa.string()), pa.array(self.close_pos, pa.int64())
        kind, parent = pa.array(kind, pa.int8()), pa.array(parent, pa.int64())
        attrs = pa.MapArray.from_arrays(pa.array((*starts, len(self.keys)), pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()))
        of_parent = lambda column, none=None: column.take(parent) if none is None else column.take(parent).fill_null(none)
        return [
            pos, pa.array(_KINDS, pa.string()).take(kind), tag, attrs, pa.array(text, pa.string()), close_pos, of_parent(pos, -1),
            pa.array(depth, pa.int32()), of_parent(tag), of_parent(pa.array(cls, pa.string())), pa.compute.equal(kind, _RAW),
            of_parent(close_pos, -1),
        ]


def tokenize_one(html: str, keep_tags: frozenset[str] | None = None) -> dict:
    """Column lists of one document's tokens (used by tests)."""
    t = _Tokenizer(keep_tags)
    t.document(html)
    return {k: c.to_pylist()[1:] for (k, _), c in zip(NODE_FIELDS, t.columns())}


def _small(batches):
    """Slices whose texts have some megabytes at most (or one longer text), so that token rows stay bounded."""
    for batch in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column("__html")), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(size):
            if total and total + n > OUT_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def _tokenize_batches(batches, carry: list[str], keep_tags: frozenset[str] | None = None):
    for batch in _small(batches):
        rows, take = _Tokenizer(keep_tags), []
        for i, html_text in enumerate(batch.column("__html").to_pylist()):
            before = len(rows.rows)
            rows.document(html_text)
            take.extend([i] * (len(rows.rows) - before))
        idx = pa.array(take, pa.int64())
        arrays = [batch.column("article_id").take(idx), *rows.columns(), *(batch.column(c).take(idx) for c in carry)]
        yield pa.RecordBatch.from_arrays(arrays, names=["article_id", *(k for k, _ in NODE_FIELDS), *carry])


def node_schema(articles: DataFrame, carry: list[str]) -> T.StructType:
    fields = [T.StructField("article_id", T.LongType())]
    fields += [T.StructField(n, t) for n, t in NODE_FIELDS]
    by_name = {f.name: f for f in articles.schema.fields}
    fields += [T.StructField(c, by_name[c].dataType) for c in carry]
    return T.StructType(fields)


def by_article(df: DataFrame, partitions: int = 0) -> DataFrame:
    """Rows in as many partitions by ``article_id`` as the session's shuffles have, whatever their bytes, or as ``partitions`` if these are more."""
    return df.repartition(max(partitions, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "article_id")


def task_partitions(articles: DataFrame, html_col: str = "text") -> int:
    """How many tasks the articles' node rows ask for, by ``TASK_CHARS``: a pass over the articles alone."""
    return -(-(articles.agg(F.sum(F.length(html_col))).first()[0] or 0) // TASK_CHARS)


def stage_cut(nodes: DataFrame, partitions: int) -> DataFrame:
    """The rows dealt by article anew (into one partition more, or the exchange would be left out), so that a new stage begins.

    A task compiles what its stage generates unless its executor still holds it, and Spark holds 100 classes
    (``spark.sql.codegen.cache.maxEntries``) in four parts. A stage of more windows than that allows compiles all its classes in every task,
    which costs more than the exchange of the rows.
    """
    return nodes.repartition(max(partitions, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1, "article_id")


def tokenize(articles: DataFrame, html_col: str = "text", carry: list[str] | None = None,
             keep_tags: frozenset[str] | None = None, grouped: bool = False, partitions: int | None = None) -> DataFrame:
    """DOC-1: articles (article_id, <html_col>, carried columns) -> node rows.

    Filters placed before this call are pushed to the scan; nothing is pushed through
    it, so callers filter first.  NULL HTML is not tokenized (FLT-7): such articles get
    only their ``doc`` row. Elements beyond ``keep_tags``, if given, have no row: what they hold
    belongs to the element around them.

    Node rows that windows sort take up to some hundred times their text, so a task gets the rows of ``TASK_CHARS`` characters on
    average, whatever the input's size: the characters of ``grouped`` articles are summed first, unless ``partitions`` is given.

    The articles are dealt out first, as a small file is one task, whatever it grows to. ``grouped``
    rows are partitioned by article, which all windows and groups by article use: a few packed megabytes, to which adaptive
    execution joins partitions, are too much for the sorts of a task, so these are as many as the session's shuffles have.
    """
    carry = [c for c in (carry or []) if c not in ("article_id", html_col)]
    src = articles.select(F.col("article_id").cast("long").alias("article_id"),
                          F.coalesce(F.col(html_col), F.lit("")).alias("__html"), *carry)
    schema = node_schema(articles, carry)
    partitions = (task_partitions(src, "__html") if partitions is None else partitions) if grouped else 0
    nodes = by_article(src, partitions).mapInArrow(lambda it: _tokenize_batches(it, carry, keep_tags), schema)
    return by_article(nodes, partitions) if grouped else nodes


# --------------------------------------------------------------------------- windows


def article_window() -> Window:
    """Document order inside one article (all node windows share it: one exchange, one sort)."""
    return Window.partitionBy("article_id").orderBy("pos")


def running(w: Window | None = None) -> Window:
    return (w or article_window()).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def drop_subtrees(nodes: DataFrame, hit: Column) -> DataFrame:
    """WIN-3 / JOIN-10: remove every element where ``hit`` holds, with its subtree.

    A row is inside a hit interval iff the running max of ``close_pos`` over hit rows up
    to it reaches its ``pos``.  Text after the element (its tail) stays.
    """
    reach = F.max(F.when(hit & (F.col("kind") == "open"), F.col("close_pos"))).over(running())
    return (
        nodes.withColumn("__reach", reach)
        .where((F.col("kind") == "doc") | F.col("__reach").isNull() | (F.col("pos") > F.col("__reach")))
        .drop("__reach")
    )


def enclosing(flag: Column, value: Column, w: Window | None = None) -> Column:
    """Value of an element around the row (or of the row itself) where ``flag`` holds: the last one opened, or
    where that is closed already, the outermost one that is still open."""
    own = F.when(flag & (F.col("kind") == "open"), F.struct(F.col("close_pos").alias("c"), value.alias("v")))
    last, widest = F.last(own, ignorenulls=True).over(running(w)), F.max(own).over(running(w))
    return F.when(last["c"] >= F.col("pos"), last["v"]).when(widest["c"] >= F.col("pos"), widest["v"])


def has_enclosing(flag: Column, strict: bool = True) -> Column:
    """Some *ancestor* (strict) or the row itself matches ``flag``: running max of hit close_pos."""
    frame = article_window().rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    reach = F.max(F.when(flag & (F.col("kind") == "open"), F.col("close_pos"))).over(frame)
    return F.coalesce(reach >= F.col("pos"), F.lit(False))


def of_parent(nodes: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Adds what each flag is at the row's parent (null without one), for all flags by one window.

    An element stands in the window of its siblings by ``parent_pos`` and, as a marker, in that of its children by ``pos``; the marker
    carries the flags. Dropped subtrees leave the parents of what stays as they are; after elements were unwrapped,
    ``rebuild_parents`` comes first.
    """
    own = {f"__own_{k}": v for k, v in flags.items()}
    entry = lambda at, marker: F.struct(F.col(at).alias("at"), F.lit(marker).alias("marker"))
    places = F.when(F.col("kind") == "open", F.array(entry("parent_pos", False), entry("pos", True))).otherwise(F.array(entry("parent_pos", False)))
    rows = nodes.withColumns(own).select("*", F.explode(places).alias("__place"))
    rows = rows.withColumns({"__at": F.col("__place.at"), "__marker": F.col("__place.marker")})
    family = Window.partitionBy("article_id", "__at")
    rows = rows.withColumns({k: F.max(F.when(F.col("__marker"), F.col(f"__own_{k}"))).over(family) for k in flags})
    return rows.where(~F.col("__marker")).drop("__place", "__at", "__marker", *own)


def rebuild_parents(nodes: DataFrame) -> DataFrame:
    """``parent_pos``, ``depth``, ``ptag``, ``pclass`` and ``pclose`` anew from the intervals: each row's parent is the nearest element
    around it that is still there, whatever was unwrapped.

    An element gives two markers, where it opens and where it closes. The running sum of the markers is the depth; the parent of a row
    at depth d is the last element that opened at depth d - 1, found by a window over (article, depth) in which an element's opening marker
    stands one deeper than itself. Rows that close nothing (text, void elements) never hold another.
    """
    zero = F.lit(0)
    holds = (F.col("kind") == "open") & (F.col("close_pos") > F.col("pos"))
    event = lambda at, order, by: F.struct(at.cast("long").alias("at"), F.lit(order).alias("order"), F.lit(by).alias("by"))
    # at one place: an element closes before, and opens its inside after, the rows there
    row, opens, closes = event(F.col("pos"), 1, 0), event(F.col("pos"), 2, 1), event(F.col("close_pos"), 0, -1)
    rows = nodes.select("*", F.explode(F.when(holds, F.array(row, opens, closes)).otherwise(F.array(row))).alias("__e"))
    order = Window.partitionBy("article_id").orderBy("__e.at", "__e.order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__depth", F.sum("__e.by").over(order)).where(F.col("__e.order") != zero)
    level = Window.partitionBy("article_id", "__depth").orderBy("__e.at", "__e.order").rowsBetween(Window.unboundedPreceding, -1)
    me = F.struct(F.col("pos").alias("p"), F.col("tag").alias("t"), F.col("attrs")["class"].alias("c"), F.col("close_pos").alias("e"))
    rows = rows.withColumn("__up", F.last(F.when(F.col("__e.order") == 2, me), ignorenulls=True).over(level)).where(F.col("__e.order") == 1)
    inside = (F.col("kind") != "doc") & (F.col("__depth") > 0)
    new = {
        "parent_pos": F.when(inside, F.col("__up.p")).otherwise(F.lit(-1)), "depth": F.when(F.col("kind") == "doc", F.col("depth")).otherwise(F.col("__depth")).cast("int"),
        "ptag": F.when(inside, F.col("__up.t")), "pclass": F.when(inside, F.col("__up.c")), "pclose": F.when(inside, F.col("__up.e")).otherwise(F.lit(-1)),
    }
    return rows.withColumns({k: v.cast(nodes.schema[k].dataType) for k, v in new.items()}).drop("__e", "__depth", "__up")


# --------------------------------------------------------------------------- serialise


def escape_text(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def escape_attr(c: Column) -> Column:
    return F.replace(escape_text(c), F.lit('"'), F.lit("&quot;"))


def start_tag(tag: Column, attrs: Column) -> Column:
    pairs = F.transform(F.map_entries(attrs), lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), escape_attr(e["value"]), F.lit('"')))
    return F.concat(F.lit("<"), tag, F.when(F.cardinality(attrs) > 0, F.array_join(pairs, "")).otherwise(F.lit("")), F.lit(">"))


def serialise(nodes: DataFrame, wrap_tag: str | None = "div", extra_aggs: list | None = None) -> DataFrame:
    """DOC-16 / AGG-5: (article_id, html, *extra_aggs) with tokens in document order.

    Each open row gives its start tag at key ``(pos, 0, 0)`` and, unless void, its end tag
    at ``(close_pos, 0, 0)``; rows may override the keys with ``okey``/``ckey`` structs (moved
    subtrees, inserted header pieces).  One ordered ``collect_list`` per article, on the
    ``article_id`` partitioning the node windows already produced; every article keeps a
    row, even one without tokens.
    """
    cols = nodes.columns
    zero = F.lit(0).cast("long")
    okey, ckey = F.col("pos"), F.col("close_pos")
    if {"okey", "ckey"} & set(cols):  # keys of places between two tokens; without them positions are enough
        key = lambda at, own: F.coalesce(*[F.col(own)] * (own in cols), F.struct(F.col(at).alias("a"), zero.alias("b"), zero.alias("c")))
        okey, ckey = key("pos", "okey"), key("close_pos", "ckey")
    kind = F.col("kind")
    void = F.col("tag").isin(*VOID_TAGS)
    piece = (
        F.when(kind == "open", start_tag(F.col("tag"), F.col("attrs")))
        .when((kind == "text") & F.col("raw"), F.col("text"))
        .when(kind == "text", escape_text(F.col("text")))
        .when(kind == "html", F.col("text"))
    )
    items = F.when(
        (kind == "open") & ~void,
        F.array(F.struct(okey.alias("k"), piece.alias("s")),
                F.struct(ckey.alias("k"), F.concat(F.lit("</"), F.col("tag"), F.lit(">")).alias("s"))),
    ).when(piece.isNotNull(), F.array(F.struct(okey.alias("k"), piece.alias("s"))))
    extra_aggs = extra_aggs or []
    # sort_array compares by itself and ["s"] takes the field of all; array_sort and transform would interpret a function for each item
    parts = nodes.select("*", F.explode_outer(items).alias("it"))
    body = parts.groupBy("article_id").agg(
        F.array_join(F.sort_array(F.collect_list("it"))["s"], "").alias("html"),
        *extra_aggs,
    )
    if wrap_tag:
        body = body.withColumn("html", F.concat(F.lit(f"<{wrap_tag}>"), F.col("html"), F.lit(f"</{wrap_tag}>")))
    return body


def new_node(nodes: DataFrame, **vals) -> Column:
    """A struct with the node table's columns but ``article_id`` for an inserted row (unset columns NULL)."""
    fields = [f for f in nodes.schema.fields if f.name != "article_id"]
    # the unset columns by one expression, so that a plan with many inserted rows is built quickly
    out = F.expr("named_struct(" + ", ".join(f"'{f.name}', CAST(NULL AS {f.dataType.simpleString()})" for f in fields) + ")")
    for f in fields:
        v = vals.get(f.name)
        if v is not None:
            out = out.withField(f.name, (v if isinstance(v, Column) else F.lit(v)).cast(f.dataType))
    return out


def with_inserts(nodes: DataFrame, new_rows: Column) -> DataFrame:
    """Add rows: ``new_rows`` is an array of ``new_node`` structs of these nodes per row (or NULL).

    ``explode`` keeps the article partitioning, so inserted rows need no exchange; the next
    window re-sorts locally.
    """
    cols = [c for c in nodes.columns if c != "article_id"]
    me = F.expr("struct(" + ", ".join(f"`{c}`" for c in cols) + ")")
    rows = F.when(new_rows.isNull() | (F.size(new_rows) == 0), F.array(me)).otherwise(F.concat(F.array(me), new_rows))
    # article_id stays the same attribute, so the article partitioning is still known
    return nodes.select("article_id", F.explode(rows).alias("__r")).selectExpr("article_id", *[f"__r.`{c}` AS `{c}`" for c in cols])
