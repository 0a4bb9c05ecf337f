"""A hot key holding a third of all rows: our forms against the plain ones.

Copies of the test tables are written to a new scratch folder, with a third of the rows
moved to one exercise or one user.  Usage: python trials/skew.py [copies]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent.parent))

from pyspark.sql import DataFrame, Window as W, functions as F

from daybook import build_session
from daybook.catalog.registry import UNWEIGHTED, Tables
from daybook.operators import fill, stats, windows
from daybook.operators.joins import enrich_intervals
from daybook.plans.strength import strength_metrics, with_one_rep_max

FOLDER = "/root/testdata/sf0.1"


def copies(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")


def timed(name: str, df: DataFrame) -> None:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)


def main(n: int) -> None:
    spark = build_session("daybook-skew", "local[8]", **{
        "spark.sql.shuffle.partitions": "32", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tables = Tables(spark, FOLDER)

    hot = F.when(F.rand(1) < 0.34, "hot").otherwise(F.col("exercise_name"))
    copies(tables.sets, n).withColumn("exercise_name", hot).repartition(16).write.parquet(f"{scratch}/sets")
    sets = spark.read.parquet(f"{scratch}/sets")
    print(f"{sets.count()} sets")
    series = W.partitionBy("exercise_name").orderBy(F.unix_date("date"))
    plain = with_one_rep_max(sets, unweighted=UNWEIGHTED).select(
        "*", F.max("one_rep_max").over(series.rangeBetween(W.unboundedPreceding, 0)).alias("cummax"),
        F.max("one_rep_max").over(series.rangeBetween(-89, 0)).alias("rolling"))
    timed("maxima, daily table joined back", strength_metrics(sets, unweighted=UNWEIGHTED))
    start = time.perf_counter()
    settled = strength_metrics(sets, unweighted=UNWEIGHTED, settle_in=scratch)
    print(f"maxima, writing the daily table: {time.perf_counter() - start:.1f} s")
    timed("maxima, daily table read back", settled)
    timed("maxima, window over rows", plain)

    jitter = F.make_dt_interval(secs=(F.rand(3) * 3600).cast("decimal(18,6)"))
    user = F.when(F.rand(2) < 0.34, F.lit(-1)).otherwise(F.col("user_id"))
    spread = copies(tables.events, max(1, n // 2)).withColumns({"user_id": user, "ts": F.col("ts") + jitter})
    spread.repartition(16).write.parquet(f"{scratch}/events")
    events = spark.read.parquet(f"{scratch}/events").withColumnRenamed("ts", "start")
    print(f"{events.count()} events")
    hours = events.where("event_type = 'signup'").select(
        "user_id", "event_id", "start", (F.col("start") + F.expr("interval 1 hour")).alias("end"))
    wanted = {"click_mean": ("click", "avg"), "view_sum": ("view", "sum")}
    timed("intervals, tree of cells", enrich_intervals(
        hours, events, wanted, ["user_id"], m_end=None, kind="event_type"))
    m = events.select(F.col("user_id").alias("u"), F.col("start").alias("t"), "event_type", "value").where(
        "event_type IN ('click', 'view')")
    theta = hours.join(m, F.expr("u = user_id AND t >= start AND t <= end"), "left")
    timed("intervals, pairs", theta.groupBy(*hours.columns).agg(
        F.expr("avg(value) FILTER (WHERE event_type = 'click')").alias("click_mean"),
        F.expr("sum(value) FILTER (WHERE event_type = 'view')").alias("view_sum")))

    # A third of all readings at one time, of which half are the same unknown one.
    tied = F.col("user_id") == -1
    rows = events.select("user_id", F.when(tied, F.lit("2024-01-05").cast("date")).otherwise(F.to_date("start")).alias("date"),
                         F.when(tied, F.lit(0)).otherwise(F.hour("start")).alias("at"),
                         F.when(tied & (F.col("event_id") % 2 == 0), -1).otherwise(F.col("event_id")).alias("event_id"),
                         F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    rows = rows.withColumn("value", F.when(F.col("event_id") >= 0, F.col("value")))
    timed("interpolation, a third of all rows in one tie", fill.interpolate(rows, "value", ["user_id"], order=["at", "event_id"], bound=200_000))
    names = spark.range(1_000_000 * max(1, n // 10)).select(
        F.concat(F.lit("the same beginning "), F.lpad(F.col("id").cast("string"), 9, "0")).alias("c"), F.lit(1.0).alias("v"))
    timed("numbers by median, one median and one beginning", stats.order_by_median(names, "c", "v", bound=200_000))
    one = spark.createDataFrame([("a", 20_000_000)], "s string, times long")
    timed("one row written 20,000,000 times", windows.repeat_rows(one, "times", out="nth"))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 20)
