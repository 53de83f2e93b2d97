from pagelex.sources.siteinfo import Dims, Site, dims_from_tables


def make_dims(spark, namespaces=(), interwiki=None, server="", articlepath="/wiki/", local=None):
    """Dims from plain Python values: namespaces as names (given id 10+i), interwiki as dict."""
    site = Site("Test", "en", False, "", "", articlepath, server)
    ns_rows = [(i, 10 + i, None, n) for i, n in enumerate(namespaces)]
    ns = spark.createDataFrame(ns_rows, "pos int, id long, canonical string, name string")
    iw_rows = [(i, k, v) for i, (k, v) in enumerate((interwiki or {}).items())]
    iw = spark.createDataFrame(iw_rows, "pos int, prefix string, url string")
    return dims_from_tables(site, ns, iw, local)
