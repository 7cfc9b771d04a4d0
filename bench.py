"""Time the eleven queries: prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local cores. Every
query runs in full once to warm up the JVM and once for its time; results are consumed
without being collected. Beside them, ``pairs`` times the pairs of suppliers that two orders
or more share, of which there are hundreds of thousands at sf 0.1.
"""

from __future__ import annotations

import json
import os
import time

from grainfold import tables
from grainfold.operators.itemsets import frequent_itemsets
from grainfold.registry.queries import QUERIES
from grainfold.session import local_session

HEADLINE = [
    "photos_per_locality",
    "top_localities",
    "locality_tags",
    "top_tags_per_locality",
    "measurements_per_researcher",
    "cell_clusters",
    "cell_clusters_trimmed",
    "genre_average_rating",
    "cancers_with_active_gene",
    "gene_itemsets",
    "gene_rules",
]


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def supplier_pairs(spark, folder: str) -> dict:
    items = tables.table(spark, folder, "lineitem")
    orders = items.select("l_orderkey").distinct().count()
    started = time.perf_counter()
    sets = frequent_itemsets(items, "l_orderkey", "l_suppkey", 2.5 / orders, 2)
    n = sets.where("size(items) = 2").count()
    return {"seconds": round(time.perf_counter() - started, 3), "frequent_pairs": n}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(seconds(spark, name, folder), 3)
    pairs = supplier_pairs(spark, folder)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total time of the eleven queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "pairs": pairs,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
