"""TeX source normalisation as Spark expressions (TEX-1) and the macro dictionary (TEX-2)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .urls import col_or_lit

# ---------------------------------------------------------------------------
# The wiki TeX prefilter, (pattern, replacement) in application order.
# Patterns are RE2/Java compatible; replacements use Java's $n group syntax.
PREFILTER = [
    (r"([^\\])%", r"$1\\%"),
    (r"\\iiint([^!]*)!\\!\\!\\!\\!.*\\subset\\!\\supset", r"\\iiint$1\\!\\subset\\!\\supset"),
    (r"\\iint([^!]*)!\\!\\!\\!\\!\\!\\!\\!\\!\\!\\!(.*)\\subset\\!\\supset", r"\\iint$1$2\\subset\\!\\!\\supset"),
    (r"\\int\\!\\!\\!(\\!)+\\int\\!\\!\\!(\\!)+\\int([^!]*)!\\!\\!\\!\\!.*\\bigcirc(\\,)*", r"\\iiint$3\\subset\\!\\supset"),
    (r"\\int\\!\\!\\!(\\!)+\\int([^!]*)!\\!\\!\\!\\!\\!\\!\\!\\!(.*)\\bigcirc(\\,)*", r"\\iint$2$3\\subset\\!\\!\\supset"),
]

# Wiki-dialect TeX macros -> standard TeX, in the order the dialect lists
# them (name, expansion, number of arguments).
MACROS = [
    ("C", r"\mathbb{C}", 0), ("Complex", r"\mathbb{C}", 0), ("cnums", r"\mathbb{C}", 0),
    ("H", r"\mathbb{H}", 0), ("N", r"\mathbb{N}", 0), ("natnums", r"\mathbb{N}", 0),
    ("Q", r"\mathbb{Q}", 0), ("R", r"\mathbb{R}", 0), ("reals", r"\mathbb{R}", 0),
    ("Reals", r"\mathbb{R}", 0), ("Z", r"\mathbb{Z}", 0),
    ("thetasym", r"\vartheta", 0), ("koppa", r"\unicode{x3DF}", 0), ("stigma", r"\unicode{x3DB}", 0),
    ("coppa", r"\unicode{x3D9}", 0),
    ("Alpha", r"\unicode{x391}", 0), ("Beta", r"\unicode{x392}", 0), ("Epsilon", r"\unicode{x395}", 0),
    ("Zeta", r"\unicode{x396}", 0), ("Eta", r"\unicode{x397}", 0), ("Iota", r"\unicode{x399}", 0),
    ("Kappa", r"\unicode{x39A}", 0), ("Mu", r"\unicode{x39C}", 0), ("Nu", r"\unicode{x39D}", 0),
    ("Omicron", r"\unicode{x39F}", 0), ("Rho", r"\unicode{x3A1}", 0), ("Tau", r"\unicode{x3A4}", 0),
    ("Chi", r"\unicode{x3A7}", 0), ("Koppa", r"\unicode{x3DE}", 0), ("Stigma", r"\unicode{x3DA}", 0),
    ("Coppa", r"\unicode{x3D8}", 0),
    ("sect", r"\S", 0), ("P", r"\P", 0), ("AA", r"\unicode{xC5}", 0), ("alef", r"\aleph", 0),
    ("alefsym", r"\aleph", 0), ("weierp", r"\wp", 0), ("real", r"\Re", 0), ("part", r"\partial", 0),
    ("infin", r"\infty", 0), ("empty", r"\emptyset", 0), ("O", r"\emptyset", 0), ("ang", r"\angle", 0),
    ("exist", r"\exists", 0), ("clubs", r"\clubsuit", 0), ("diamonds", r"\diamondsuit", 0),
    ("hearts", r"\heartsuit", 0), ("spades", r"\spadesuit", 0), ("textvisiblespace", r"\unicode{x2423}", 0),
    ("and", r"\land", 0), ("or", r"\lor", 0), ("bull", r"\bullet", 0), ("plusmn", r"\pm", 0),
    ("sdot", r"\cdot", 0), ("supe", r"\supseteq", 0), ("sube", r"\subseteq", 0), ("isin", r"\in", 0),
    ("hAar", r"\Leftrightarrow", 0), ("hArr", r"\Leftrightarrow", 0), ("Harr", r"\Leftrightarrow", 0),
    ("Lrarr", r"\Leftrightarrow", 0), ("lrArr", r"\Leftrightarrow", 0), ("lArr", r"\Leftarrow", 0),
    ("Larr", r"\Leftarrow", 0), ("rArr", r"\Rightarrow", 0), ("Rarr", r"\Rightarrow", 0),
    ("harr", r"\leftrightarrow", 0), ("lrarr", r"\leftrightarrow", 0), ("larr", r"\leftarrow", 0),
    ("gets", r"\leftarrow", 0), ("rarr", r"\rightarrow", 0), ("uarr", r"\uparrow", 0),
    ("darr", r"\downarrow", 0), ("Uarr", r"\Uparrow", 0), ("uArr", r"\Uparrow", 0),
    ("Darr", r"\Downarrow", 0), ("dArr", r"\Downarrow", 0), ("rang", r"\rangle", 0), ("lang", r"\langle", 0),
    ("oiint", r"\unicode{x222F}", 0), ("oiiint", r"\unicode{x2230}", 0),
    ("sgn", r"\operatorname{sgn}", 0), ("arccot", r"\operatorname{arccot}", 0),
    ("arcsec", r"\operatorname{arcsec}", 0), ("arccsc", r"\operatorname{arccsc}", 0),
    ("bold", r"\mathbf{#1}", 1), ("href", r"\operatorname{href}", 0), ("style", r"\operatorname{style}", 0),
    ("pagecolor", "", 1), ("vline", r"\smash{\large\lvert}", 0), ("image", r"\Im", 0),
]
# ---------------------------------------------------------------------------

MACRO_TOKEN_RE = r"\\([A-Za-z]+)"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def prefilter(tex) -> Column:
    """TEX-1: escape bare '%' and rewrite the old multiple-integral spacing hacks."""
    c = col_or_lit(tex)
    for pat, rep in PREFILTER:
        c = F.regexp_replace(c, pat, rep)
    return c


def macros_dim(spark: SparkSession) -> DataFrame:
    """TEX-2 dimension: (macro, expansion, n_args), 91 rows."""
    return spark.createDataFrame(MACROS, "macro string, expansion string, n_args int")


def macro_uses(texts: DataFrame, tex_col: str = "tex") -> DataFrame:
    """Control words of each TeX source matched against the dictionary (broadcast join):
    (``macro``, ``expansion``, ``n_args``) per use, with the source's other columns."""
    toks = texts.select("*", F.explode(F.regexp_extract_all(F.col(tex_col), F.lit(MACRO_TOKEN_RE), 1)).alias("macro"))
    return toks.join(F.broadcast(macros_dim(texts.sparkSession)), "macro")


# --------------------------------------------------------------------------- expansion

# A control word, another control sequence, one brace, a run of blanks or a run of anything else.
TEX_TOKEN_RE = r"(?s)\\[A-Za-z]+|\\.|\\$|[{}]|\s+|[^\\{}\s]+"
FRAME = "struct<macro:string,template:string,depth:int,text:string>"


def closed_macros(macros=None) -> dict[str, tuple[str, int]]:
    """The dictionary with its expansions expanded: macro -> (text, arguments). Macros that reach themselves by their
    expansions are left out: they stay as they are (the cycle guard)."""
    table = {m: (text, n) for m, text, n in (MACROS if macros is None else macros)}
    if any(n > 1 for _, n in table.values()):
        raise ValueError("macros of more than one argument are not supported")
    words = re.compile(MACRO_TOKEN_RE)
    uses = {m: {w for w in words.findall(text) if w in table} for m, (text, _) in table.items()}

    def cyclic(m: str) -> bool:
        seen, todo = set(), list(uses[m])
        while todo:
            w = todo.pop()
            if w == m:
                return True
            if w not in seen:
                seen.add(w)
                todo += uses[w]
        return False

    plain = {m: x for m, x in table.items() if not cyclic(m)}

    def full(text: str) -> str:
        for w in words.findall(text):
            if w in plain and plain[w][1]:
                raise ValueError(f"an expansion uses \\{w}, which takes an argument")
        return words.sub(lambda w: full(plain[w[1]][0]) if w[1] in plain else w[0], text)

    return {m: (full(text), n) for m, (text, n) in plain.items()}


def expand(tex, macros=None) -> Column:
    """TEX-2: the TeX source with all dictionary macros written out, also within arguments, in one fold over its tokens.

    The fold keeps a stack of frames: at the bottom the text so far, above it a frame for each macro whose argument is being read. An
    argument is a group with balanced braces, or after blanks the next single character or control sequence (which gets none of its own). A macro
    without an argument (the source or the group around it ends) and a group that is never closed stay as written; null stays null.
    """
    table = closed_macros(macros)
    dictionary = F.create_map(*[F.lit(x) for m, (text, _) in table.items() for x in ("\\" + m, text)]) if table else F.create_map().cast("map<string,string>")
    unary = [f"\\{m}" for m, (_, n) in table.items() if n == 1]
    is_unary = lambda t: t.isin(*unary) if unary else F.lit(False)

    def frame(macro, template, depth, text):
        return F.struct(macro.alias("macro"), template.alias("template"), depth.cast("int").alias("depth"), text.alias("text"))

    none = F.lit(None).cast("string")

    def pop(stack: Column) -> Column:
        return F.slice(stack, F.lit(1), F.size(stack) - 1)

    def with_top(stack: Column, top: Column) -> Column:
        return F.concat(pop(stack), F.array(top))

    def append(stack: Column, text: Column) -> Column:
        return bound(F.element_at(stack, -1), lambda top: with_top(stack, frame(top["macro"], top["template"], top["depth"], F.concat(top["text"], text))))

    def done(stack: Column, argument: Column) -> Column:
        """The top macro has its argument: its expansion goes to the frame below."""
        return bound(F.element_at(stack, -1), lambda top: append(pop(stack), F.replace(top["template"], F.lit("#1"), argument)))

    def raw(stack: Column) -> Column:
        """The top frame as it was written, at the frame below."""
        return bound(F.element_at(stack, -1), lambda top: append(pop(stack), F.concat(top["macro"], F.when(top["depth"] > 0, F.lit("{")).otherwise(F.lit("")), top["text"])))

    def read(stack: Column, t: Column) -> Column:
        known = F.element_at(dictionary, t)
        opens = F.concat(stack, F.array(frame(t, known, F.lit(0), F.lit(""))))
        return F.when(is_unary(t), opens).otherwise(append(stack, F.coalesce(known, t)))

    def step(stack: Column, t: Column) -> Column:
        def by_top(top: Column) -> Column:
            waiting = top["macro"].isNotNull() & (top["depth"] == 0)
            inside = top["macro"].isNotNull() & (top["depth"] > 0)
            deeper = lambda by: with_top(stack, frame(top["macro"], top["template"], top["depth"] + by, F.concat(top["text"], t)))
            single = F.when(F.startswith(t, F.lit("\\")), t).otherwise(F.substring(t, 1, 1))
            rest = F.when(F.startswith(t, F.lit("\\")), F.lit("")).otherwise(t.substr(F.lit(2), F.length(t)))
            return (
                # blanks between a macro and its argument go, but come back if there is none
                F.when(waiting & t.rlike(r"^\s+$"), append(stack, t))
                .when(waiting & (t == "{"), with_top(stack, frame(top["macro"], top["template"], F.lit(1), F.lit(""))))
                .when(waiting & (t == "}"), bound(raw(stack), lambda below: step_closing(below)))
                .when(waiting, append(done(stack, F.coalesce(F.when(~is_unary(single), F.element_at(dictionary, single)), single)), rest))
                .when(inside & (t == "{"), deeper(1))
                .when(inside & (t == "}") & (top["depth"] > 1), deeper(-1))
                .when(inside & (t == "}"), done(stack, top["text"]))
                .otherwise(read(stack, t))
            )

        def step_closing(below: Column) -> Column:
            """A closing brace after a macro without argument: it ends the group of the frame below."""
            return bound(F.element_at(below, -1), lambda top: F.when(top["macro"].isNull(), append(below, t))
                         .when(top["depth"] > 1, with_top(below, frame(top["macro"], top["template"], top["depth"] - 1, F.concat(top["text"], t))))
                         .when(top["depth"] == 1, done(below, top["text"])).otherwise(append(below, t)))

        return bound(F.element_at(stack, -1), by_top)

    def unwound(stack: Column) -> Column:
        """Frames that are still open stay as written, from the top one down."""
        return F.element_at(F.aggregate(F.sequence(F.lit(1), F.size(stack)), stack, lambda s, i: F.when(F.size(s) > 1, raw(s)).otherwise(s)), -1)["text"]

    c = col_or_lit(tex)
    tokens = F.regexp_extract_all(c, F.lit(TEX_TOKEN_RE), F.lit(0))
    start = F.array(frame(none, none, F.lit(0), F.lit(""))).cast(f"array<{FRAME}>")
    return F.when(c.isNotNull(), bound(F.aggregate(tokens, start, step), unwound))
