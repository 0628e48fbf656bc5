"""Write PLANS.md: the physical-plan facts of the scale-critical operators.

    python tools/show_plans.py [sf_dir]

For each plan it records the operators that matter at scale — exchanges, join
strategies, scans with their pruned read schema, pushed and partition filters —
taken from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import SparkConf  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tierlake import catalog  # noqa: E402
from tierlake.operators.merge import merge_plan  # noqa: E402
from tierlake.plans.lakehouse import Lakehouse  # noqa: E402
from tierlake.plans.layers import gold_batch, silver_batch, silver_transform  # noqa: E402
from tierlake.schemas import SILVER_KEYS  # noqa: E402
from tierlake.session import build_session  # noqa: E402
from tierlake.sources.fixtures import as_trips, read_table  # noqa: E402

KEEP = re.compile(r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                  r"BroadcastNestedLoop|CartesianProduct|TakeOrdered|HashAggregate|Window|"
                  r"Scan parquet|Union)")
DETAIL = re.compile(r"^(ReadSchema|PushedFilters|PartitionFilters|DataFilters):|"
                    r"^Arguments: (RoundRobinPartitioning|hashpartitioning|rangepartitioning"
                    r"|SinglePartition)")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> list[str]:
    tree, details = [], []
    head, _, body = text.partition("\n\n")
    for line in head.splitlines():
        if KEEP.search(line):
            tree.append(line.rstrip())
    for line in body.splitlines():
        if DETAIL.match(line) and line not in details:
            details.append(line if len(line) < 220 else line[:217] + "...")
    return tree + [""] + details


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("plans", master="local[8]",
                          conf={"spark.sql.shuffle.partitions": "8",
                                **({} if SparkConf().get("spark.checkpoint.dir", None) else
                                   {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})})
    spark.sparkContext.setLogLevel("ERROR")
    sections = []

    t, s = catalog._split(spark, sf)
    for label, strategy in [("as Spark plans it", "auto"), ("sort-merge joins", "shuffle")]:
        r = merge_plan(silver_batch(t, "b1", catalog.T1), silver_batch(s, "b2", catalog.T2),
                       SILVER_KEYS, preserve=["ingested_date"], strategy=strategy)
        sections.append((f"Silver upsert, {label}", summarize(plan_text(r.df))))

    for name in ["log_dedup_latest", "gold_trip_revenue", "gold_limit", "quality_report",
                 "log_failed_count", "missing_months", "table_scan", "scan_bronze"]:
        sections.append((f"Query `{name}`", summarize(plan_text(catalog.QUERIES[name](spark, sf)))))

    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    lake = Lakehouse(spark, f"{work}/lake")
    trips = as_trips(read_table(spark, sf, "lineitem"))
    lake.run_batch(trips, "b1", dt.datetime(2024, 1, 1))
    month = trips.where("tpep_pickup_datetime >= TIMESTAMP_NTZ'1996-03-01' AND "
                        "tpep_pickup_datetime < TIMESTAMP_NTZ'1996-04-01'")
    gold_src = gold_batch(silver_transform(month.drop("airport_fee")), "b2", "2024-02-01 00:00:00")
    sections.append(("Gold scope of a one-month batch (partition pruning)",
                     summarize(plan_text(lake.gold.scope(gold_src)))))
    bronze_src = month.drop("airport_fee")
    sections.append(("Bronze scope of a one-month batch (layout column pruning)",
                     summarize(plan_text(lake.bronze.scope(bronze_src)))))

    lake.run_batch(month.withColumn("trip_distance", F.lit(1.0)), "b2", dt.datetime(2024, 2, 1))
    sections.append(("One batch of the bronze table (partitions from its commit, filter on its id)",
                     summarize(plan_text(lake.bronze.extract_batch("b2")))))

    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on `{sf}` (local[8], AQE on; the tree is the",
           "initial plan, AQE may still switch a sort-merge join to broadcast at run time).", ""]
    for title, lines in sections:
        out += [f"## {title}", "", "```", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
