"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with the no-op sink (all rows produced, none collected),
once to warm up the JVM and Python workers, then timed.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["link_kinds", "url_rewrite", "thumb_width", "dump_decode", "scrape_decode", "rule_drop",
            "autonumber", "headings_toc", "formulas", "geo_points", "tiles", "convert_all"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pagelex.session import get_spark
    from pagelex.plans.queries import QUERIES

    spark = get_spark(f"local[{cpus}]", app="pagelex-bench", partitions=int(cpus) * 2)
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM, Python workers, file listing
    QUERIES["url_rewrite"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
