"""Operations of ours that the curation stages rest on but that are no one's parity: joins, cubes, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.plans.registry import query
from sluice.session import table


@query(
    "pricing_summary",
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n
    from lineitem where l_shipdate <= timestamp '1998-09-02' group by l_returnflag, l_linestatus""",
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "regional_cube",
    """select r_name, c_mktsegment, count(*) as n, grouping(r_name)::int as no_region from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey group by cube (r_name, c_mktsegment)""",
)
def regional_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.cube("r_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.grouping("r_name").cast("int").alias("no_region"))


@query(
    "user_sessions",
    """with g as (select user_id, ts, case when ts - lag(ts) over w > interval '30 minutes' then 1 else 0 end as cut from events window w as (partition by user_id order by ts, event_id)),
    s as (select user_id, sum(cut) over (partition by user_id order by ts rows unbounded preceding) as k from g)
    select user_id, count(distinct k) as sessions, count(*) as n from s group by user_id""",
)
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(own).cast("timestamp"))
    cuts = table(spark, sf_dir, "events").withColumn("cut", F.when(gap > 1_800_000_000, 1).otherwise(0))
    return cuts.groupBy("user_id").agg((F.sum("cut") + 1).alias("sessions"), F.count(F.lit(1)).alias("n"))
