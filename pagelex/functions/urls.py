"""URL scalar functions as Spark ``Column`` expressions (SCL-1..3, 5, 8, 9, 12, 13, 15).

All of these stay inside whole-stage codegen: regexes, ``concat``, ``when``.  The
link-rewrite decision list (SCL-6) that needs the namespace / interwiki dims lives in
``pagelex.operators.links``; this module supplies its column-level pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Image file extensions recognised by the image-path test:
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "svg", "gif", "bmp")
# Standard thumbnail widths; a requested width rounds up to the next one, else the last:
STANDARD_THUMB_WIDTHS = (20, 40, 60, 120, 250, 330, 500, 960, 1280, 1920, 3840)
# Host suffix whose thumbnail paths get the width rounding:
THUMB_HOST_SUFFIX = "upload.wikimedia.org"
# Schemes that Python's urllib re-emits with "//" even when the host is empty
# (urllib.parse.uses_netloc, public stdlib constant):
USES_NETLOC = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
    "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn",
    "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
# ---------------------------------------------------------------------------

# RFC-3986 style split: scheme, //netloc, path, ?query, #fragment.  RE2-compatible.
URL_SPLIT_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def col_or_lit(x) -> Column:
    """Accept a Column, a column name given as ``F.col``, or a Python literal."""
    if isinstance(x, Column):
        return x
    return F.lit(x)


def clean_url(url) -> Column:
    """Leading C0/space stripped and tab/CR/LF removed, as a URL splitter does first."""
    url = col_or_lit(url)
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def split_url(url) -> Column:
    """struct<scheme (lower-cased), netloc, path, query, fragment>; absent parts are ''."""
    # one match gives all parts: a cleaned URL has no line feed, so that these stand between them
    cut = F.split(F.regexp_replace(clean_url(url), URL_SPLIT_RE, "$1\n$2\n$3\n$4\n$5"), "\n")
    names = ("scheme", "netloc", "path", "query", "fragment")
    return F.get(F.transform(F.array(cut), lambda p: F.struct(*[(F.lower if n == "scheme" else lambda x: x)(F.get(p, i)).alias(n) for i, n in enumerate(names)])), 0)


def prefixed(sep: str, part: Column) -> Column:
    """``sep + part`` when part is non-empty, else ''."""
    return F.when(F.coalesce(part, F.lit("")) != "", F.concat(F.lit(sep), part)).otherwise(F.lit(""))


def is_image(path) -> Column:
    """SCL-1: extension after the last '.' (lower-cased) is an image extension."""
    ext = F.lower(F.regexp_extract(col_or_lit(path), r"\.([^.]*)$", 1))
    return F.coalesce(ext.isin(*IMAGE_EXTENSIONS), F.lit(False))


def replace_article_path(articlepath, site_articlepath, relative_url) -> Column:
    """SCL-2: swap a leading article path for the site's article path."""
    ap, u = col_or_lit(articlepath), col_or_lit(relative_url)
    sap = F.coalesce(col_or_lit(site_articlepath), ap)
    return F.when(
        ap.isNotNull() & F.startswith(u, ap),
        F.concat(sap, u.substr(F.length(ap) + 1, F.greatest(F.length(u), F.lit(1)))),
    ).otherwise(u)


def mk_ext_url(server, articlepath, site_articlepath, relative_url) -> Column:
    """SCL-3: server + SCL-2."""
    return F.concat(F.coalesce(col_or_lit(server), F.lit("")),
                    replace_article_path(articlepath, site_articlepath, relative_url))


def round_up_thumb_width(width) -> Column:
    """JOIN-7: smallest standard width >= width, else the largest (a forward as-of lookup
    on an 11-row dim, written as a CASE ladder so it stays in codegen)."""
    w = col_or_lit(width)
    expr = None
    for std in STANDARD_THUMB_WIDTHS:
        cond = w <= F.lit(std)
        expr = F.when(cond, F.lit(std)) if expr is None else expr.when(cond, F.lit(std))
    return expr.otherwise(F.lit(STANDARD_THUMB_WIDTHS[-1]))


def thumb_requested_width(path) -> Column:
    """Width in a trailing ``/<n>px-<name>`` path part, NULL when absent."""
    digits = F.regexp_extract(col_or_lit(path), r"/(\d+)px-[^/]+$", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def fix_thumb_width(path) -> Column:
    """SCL-5: rewrite ``/<n>px-…`` in the last path part to the standard width."""
    p = col_or_lit(path)
    digits = F.regexp_extract(p, r"/(\d+)px-[^/]+$", 1)
    # digits beyond decimal(38) fall back to the largest width, like any huge number
    width = F.coalesce(digits.try_cast("decimal(38,0)"), F.lit("1" + "0" * 30).cast("decimal(38,0)"))
    new_width = round_up_thumb_width(width)
    head = F.regexp_extract(p, r"^(.*/)\d+px-[^/]+$", 1)
    tail = F.regexp_extract(p, r"/\d+(px-[^/]+)$", 1)
    return (
        F.when(digits == "", p)
        .when(new_width == width, p)
        .otherwise(F.concat(head, new_width.cast("string"), tail))
    )


def add_http(url) -> Column:
    """SCL-8: scheme-relative URL gets ``http:``."""
    u = col_or_lit(url)
    return F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("http:"), u)).otherwise(u)


def article_path_prefix(articlepath) -> Column:
    """SCL-9: text before ``$1``; NULL/empty stays as is."""
    ap = col_or_lit(articlepath)
    return F.when(F.coalesce(ap, F.lit("")) != "", F.split(ap, r"\$1", 2).getItem(0)).otherwise(ap)


def quote_path(text) -> Column:
    """SCL-12: percent-encode like ``urllib.parse.quote`` with '/' safe."""
    enc = F.url_encode(col_or_lit(text))  # form encoding: ' ' -> '+', '~' -> %7E, '*' kept
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("%2F"), F.lit("/"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.replace(enc, F.lit("*"), F.lit("%2A"))


def unquote(text) -> Column:
    """SCL-13: percent-decode, '+' stays '+'; invalid escapes leave the text as is."""
    t = col_or_lit(text)
    return F.coalesce(F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B"))), t)


def wrap_rtl(html, rtl) -> Column:
    """SCL-15: right-to-left wrapper."""
    h = col_or_lit(html)
    return F.when(col_or_lit(rtl), F.concat(F.lit('<div dir="rtl" class="rtl">'), h, F.lit("</div>"))).otherwise(h)


def encode_article_path(path) -> Column:
    """Rule 6 of the rewrite: '/', ':' and '_' percent-encoded."""
    p = col_or_lit(path)
    p = F.replace(p, F.lit("/"), F.lit("%2F"))
    p = F.replace(p, F.lit(":"), F.lit("%3A"))
    return F.replace(p, F.lit("_"), F.lit("%20"))


def strip_ws(text) -> Column:
    """Python ``str.strip()``: all leading/trailing whitespace."""
    return F.regexp_replace(col_or_lit(text), r"^\s+|\s+$", "")
