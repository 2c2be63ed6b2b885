"""Times the headline queries: one JSON line with seconds per query and their sum.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores.
``*_reference_shape`` entries time the joins and distinct counts of the
original views on the same tables, next to the pre-aggregated plans; they are
not part of the sum.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.plans import marts
from starmill.plans import orders_feed as feed
from starmill.plans.catalogue import QUERIES
from starmill.plans.model import PUBLISHED
from starmill.session import build_session

HEADLINE = (
    "mart_season",
    "mart_alltime",
    "mart_episode",
    "mart_entity",
    "mart_by_any_grain",
    "unpivot_amounts",
    "latest_per_key",
    "ordinal_in_parent",
    "even_allocation",
    "surrogate_keys",
    "upsert_pitch",
    "upsert_deal",
    "stage_typed",
)
ONCE = ("warehouse_load", "ingest_feed", "stream_ingest")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fan_out(star: marts.Star) -> DataFrame:
    """Pitches repeated per investor, with the flags of the pitch: what the original views count over."""
    flags = marts.deal_flags(star).select("pitch_id", "has_main_shark", "has_guest_shark")
    return (
        star.pitches.drop("season_id")
        .join(star.episodes.select("episode_id", "season_id"), "episode_id")
        .join(star.deals.select("pitch_id", "shark_id"), "pitch_id", "left")
        .join(flags, "pitch_id", "left")
    )


def distinct_counts() -> list:
    pitch = F.col("pitch_id")
    return [
        F.count_distinct("episode_id").alias("total_episodes"),
        F.count_distinct(pitch).alias("total_pitches"),
        F.count_distinct(F.when(F.col("is_deal"), pitch)).alias("total_deals"),
        F.sum("deal_amount").alias("total_investment"),
        F.count_distinct("shark_id").alias("sharks_in_deals"),
        F.count_if("is_royalty_deal").alias("has_royalties"),
        F.count_if(F.col("advisory_shares") > 0).alias("has_advisory_shares"),
        F.count_if("deal_has_conditions").alias("has_conditions"),
        F.count_distinct(F.when(F.col("has_main_shark"), pitch)).alias("main_shark_deals"),
        F.count_distinct(F.when(F.col("has_guest_shark"), pitch)).alias("guest_shark_deals"),
    ]


def season_reference_shape(star: marts.Star) -> DataFrame:
    counted = fan_out(star).groupBy("season_id").agg(*distinct_counts())
    viewers = star.episodes.groupBy("season_id").agg(F.avg("us_viewership").alias("avg_us_viewership"))
    joined = marts.with_rates(counted).join(viewers, "season_id").join(marts.season_dates(star), "season_id")
    return joined.select(*PUBLISHED["vw_season_summary"])


def alltime_reference_shape(star: marts.Star) -> DataFrame:
    counted = fan_out(star).agg(F.count_distinct("season_id").alias("total_seasons"), *distinct_counts())
    viewers = star.episodes.agg(F.avg("us_viewership").alias("avg_us_viewership"))
    return marts.with_rates(counted).crossJoin(viewers).select(*PUBLISHED["vw_alltime_summary"])


def upsert_reference_shape(star: marts.Star) -> DataFrame:
    """One full outer join of the two deliveries, and one numbering of all new rows."""
    early, late = "season_id <= 5", "season_id >= 4"
    key = F.col("pitch_id") * 10 + F.col("shark_id")
    target = star.deals.filter(early).select((key + 1).alias("deal_shark_id"), "pitch_id", "shark_id", "investment_amount", "investment_equity_pct")
    source = star.deals.filter(late).select("pitch_id", "shark_id", (F.col("investment_amount") * 2).alias("new_amount"), F.lit(True).alias("is_new"))
    both = target.join(source, ["pitch_id", "shark_id"], "full")
    order = Window.partitionBy(F.col("deal_shark_id").isNull()).orderBy("pitch_id", "shark_id")
    fresh = F.row_number().over(order) + F.max("deal_shark_id").over(Window.partitionBy())
    return both.select(
        F.coalesce("deal_shark_id", fresh).alias("deal_shark_id"),
        "pitch_id",
        "shark_id",
        F.when(F.col("is_new"), F.col("new_amount")).otherwise(F.col("investment_amount")).alias("investment_amount"),
        F.when(F.col("is_new").isNull(), F.col("investment_equity_pct")).alias("investment_equity_pct"),
        F.when(F.col("is_new"), F.lit(2002)).otherwise(F.lit(2001)).alias("import_year"),
    )


def keys_reference_shape(spark, sf_dir: str) -> DataFrame:
    names = feed.read(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return names.withColumn("business_id", F.row_number().over(Window.orderBy("c_name")) + 1000)


def unpivot_reference_shape(spark, sf_dir: str) -> DataFrame:
    """One scan of the wide rows per investor."""
    rows = feed.with_keys(feed.invested_rows(spark, sf_dir))
    parts = [
        rows.filter(F.col(f"investor_{i}_investment_amount").isNotNull()).select(
            "pitch_id", F.lit(name), f"investor_{i}_investment_amount", f"investor_{i}_investment_equity"
        )
        for i, name in enumerate(feed.INVESTORS)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    return union


def timed(action, runs: int = 3) -> float:
    """Best of the runs; the first also warms the code up."""
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    spark = build_session("starmill-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {"build_star": timed(lambda: feed.build_star(spark, sf_dir))}
    star = feed.star(spark, sf_dir)
    for name in HEADLINE:
        seconds[name] = timed(lambda name=name: run(QUERIES[name](spark, sf_dir)))
    # not repeated: they write whole warehouses and files
    for name in ONCE:
        seconds[name] = timed(lambda name=name: run(QUERIES[name](spark, sf_dir)), 1)
    shapes = {
        "mart_season_reference_shape": timed(lambda: run(season_reference_shape(star))),
        "mart_alltime_reference_shape": timed(lambda: run(alltime_reference_shape(star))),
        "upsert_deal_reference_shape": timed(lambda: run(upsert_reference_shape(star))),
        "surrogate_keys_reference_shape": timed(lambda: run(keys_reference_shape(spark, sf_dir))),
        "unpivot_reference_shape": timed(lambda: run(unpivot_reference_shape(spark, sf_dir))),
    }
    result = {
        "metric": "sum of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {**seconds, **shapes},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
