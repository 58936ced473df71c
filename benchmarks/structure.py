"""Measure the structural choices: one-pass backfill against daily steps, layouts, bucketed joins.

Usage: python benchmarks/structure.py [folder]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from modelkit.operators import datelist, growth, matches  # noqa: E402
from modelkit.plans.queries import QUERIES, last_day  # noqa: E402
from modelkit.session import build_session, scratch_dir, settings  # noqa: E402
from modelkit.sources import tables  # noqa: E402


def seconds(action) -> float:
    begin = time.perf_counter()
    action()
    return round(time.perf_counter() - begin, 2)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def backfill_against_steps(spark, folder) -> None:
    events, last = tables.read_table(spark, folder, "events"), last_day(spark, folder)
    first = events.agg(F.min("ts")).first()[0].date()
    noop(growth.growth_backfill(events, "ts", last=last))
    whole = seconds(lambda: noop(growth.growth_backfill(events, "ts", last=last)))
    path = scratch_dir(spark, "growth")
    schema = growth.growth_backfill(events, "ts", last=last).schema

    def step_by_step():
        for i in range((last - first).days + 1):
            day = first + dt.timedelta(days=i)
            before = f"{path}/{day - dt.timedelta(days=1)}"
            prev = spark.read.schema(schema).parquet(before) if i else spark.createDataFrame([], schema)
            today = datelist.active_on(events, ["user_id"], "ts", day)
            growth.growth_step(prev, today, day).write.parquet(f"{path}/{day}")

    print(f"growth table, {(last - first).days + 1} days: backfill {whole} s, daily steps {seconds(step_by_step)} s")


def layouts(spark, folder) -> None:
    for row in QUERIES["layout_compare"](spark, folder).collect():
        print(f"lineitem {row['layout']}: {row['size']:,} bytes in {row['num_files']} files, {row['seconds']:.2f} s")


def bucketed_against_shuffled(spark, folder) -> None:
    base = scratch_dir(spark, "buckets")
    orders = tables.read_table(spark, folder, "orders").withColumnRenamed("o_orderkey", "k")
    lines = tables.read_table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "k")
    tables.write_bucketed(orders, "bench_orders", "k", path=f"{base}/orders")
    tables.write_bucketed(lines, "bench_lines", "k", path=f"{base}/lines")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        bucketed = matches.bucketed_join(spark, ["bench_lines", "bench_orders"], "k")
        shuffled = lines.join(orders, "k")
        for df in (bucketed, shuffled):
            noop(df)
        print(f"orders x lineitem: bucketed {seconds(lambda: noop(bucketed))} s, shuffled {seconds(lambda: noop(shuffled))} s")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "structure",
        master="local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for measure in (backfill_against_steps, layouts, bucketed_against_shuffled):
        measure(spark, folder)
    spark.stop()


if __name__ == "__main__":
    main()
