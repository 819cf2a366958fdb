"""Times the headline queries and prints one JSON line.

The given tables are one row group each, which one task has to read whatever the
engine does. They are first written as a file per core, untimed, which is how a
cluster keeps a table; the plans are those of production.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from cardweave.plans.catalog import QUERIES
from cardweave.session import build_session

HEADLINE = ("lifecycle_replay", "spend_totals", "matching_index", "linked_account_asof",
            "running_ledger_totals", "match_required", "presentment", "chargeback",
            "accounting_commands", "earmark_commands", "total_spend_update", "authorisation")


TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    name, given, folder = os.path.basename(folder), folder, tempfile.mkdtemp(prefix="cardweave-bench-")
    for table in TABLES:
        rows = spark.read.parquet(f"{given}/{table}.parquet")
        rows.repartition(1 if table in ("region", "nation") else int(cpus)).write.parquet(f"{folder}/{table}.parquet")

    def run(query: str) -> float:
        start = time.perf_counter()
        QUERIES[query](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("lifecycle_replay")  # warm the JVM
    timings = {query: round(run(query), 3) for query in HEADLINE}
    rows = (spark.read.parquet(f"{folder}/lineitem.parquet").count()
            + spark.read.parquet(f"{folder}/orders.parquet").count())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": name.removeprefix("sf"),
        "replay_rows_per_sec": round(rows / timings["lifecycle_replay"])}))


if __name__ == "__main__":
    main()
