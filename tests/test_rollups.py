"""Roll-ups by day and sketches that merge."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from txflow.operators import recon, sketches
from txflow.plans.load import Stores
from txflow.plans.report import daily_report
from txflow.sinks import landing, quarantine
from txflow.sinks.rollup import Rollups
from txflow.streaming.ingest import write_micro_batch
from test_streams import messages

DAY = date(2024, 6, 1)


def plain(report):
    return sorted(tuple(r) for r in report.collect())


def test_rolled_up_report_equals_the_report(spark, folder):
    stores = Stores.under(folder, rollups=True)
    for number, day in enumerate((1, 1, 2)):
        rows = messages(spark, range(8 * number, 8 * number + 12)).withColumn("ingested_at", F.lit(datetime(2024, 6, day, 12, number)))
        for _ in range(1 + (number == 1)):  # one batch runs again
            write_micro_batch(rows, f"x-{number}", stores)
    rolled = Rollups(spark, stores.rollups)
    landed = landing.read_landing(spark, stores.landing)
    for dt in (DAY, date(2024, 6, 2)):
        assert plain(rolled.report(dt)) == plain(daily_report(landing.sightings(landed), quarantine.read(spark, stores.quarantine), dt))
    # One day's report lists that day's folders only.
    listed = rolled.read("numbers", DAY).inputFiles()
    assert listed and all("ingest_date=2024-06-01" in name for name in listed)
    one = rolled.sketches(DAY).select(F.kll_sketch_get_n_double("lag").alias("n"), F.hll_sketch_estimate("merchants").alias("m")).first()
    assert one.n == landing.sightings(landed).where(F.col("ingest_date") == DAY).count() and one.m == 1
    assert plain(rolled.report(date(2030, 1, 1))) == plain(
        daily_report(landing.sightings(landed).where("false"), quarantine.read(spark, stores.quarantine).where("false"), date(2030, 1, 1)))


def test_a_load_on_another_day_takes_its_counts_along(spark, folder):
    rolled = Rollups(spark, folder)
    seen = spark.createDataFrame([("1", "batch")], "trans_num string, source string").withColumns(
        {"ts": F.lit(datetime(2024, 5, 1)), "merchant_id": F.lit("m")})
    none = spark.createDataFrame([], "source string, error_type string, failed_fields array<string>, ingest_date date")
    for day in (1, 2):
        rolled.add(seen.withColumn("ingested_at", F.lit(datetime(2024, 6, day))), none, "01")
    assert rolled.read("numbers", DAY).count() == 0 and rolled.read("numbers", date(2024, 6, 2)).count() == 1


@pytest.mark.parametrize("parts", [1, 6])
def test_quantile_sketches_merge(spark, parts):
    rows = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("ingestLagSeconds"), (F.col("id") % parts).alias("load"))
    exact = [r.ingestLagSeconds for r in rows.orderBy("ingestLagSeconds").collect()]
    found = sketches.lag_quantiles(sketches.lag_sketches(rows, "load")).first()
    assert found.n == len(exact)
    for p in (50, 90, 95, 99):
        rank = sum(x <= found[f"p{p}"] for x in exact) / len(exact)
        assert abs(rank - p / 100) <= 2 * sketches.RANK_ERROR


def test_weighted_lags_equal_the_lags(spark):
    rows = spark.range(500).select(F.lit("kafka").alias("source"), F.col("id").cast("string").alias("trans_num"), F.timestamp_seconds("id").alias("ts"),
                                   F.timestamp_seconds(F.col("id") + F.col("id") % 37 - 3).alias("ingested_at"))
    counts = recon.lags(rows).groupBy("ingestLagSeconds").agg(F.count("*").alias("n"))
    ours, theirs = recon.lag_distribution_of(counts).first(), recon.lag_distribution(rows).first()
    assert tuple(ours) == pytest.approx(tuple(theirs))
    assert recon.lag_distribution_of(counts.where("false")).first().n == 0


def test_distinct_counts_by_day_equal_one_pass(spark):
    edges = spark.range(40_000).select((F.col("id") % 3).alias("cardholder_id"), F.concat(F.lit("m"), F.col("id") % 9_001).alias("merchant_id"),
                                       (F.col("id") % 5).alias("day"))
    by_day = {r.cardholder: r.merchantCount for r in sketches.fanout(sketches.fanout_sketches(edges, "day")).collect()}
    once = {r.cardholder: r.merchantCount for r in sketches.fanout(sketches.fanout_sketches(edges)).collect()}
    assert by_day == pytest.approx(once, rel=0.02)
    assert by_day == pytest.approx({c: 9_001 for c in range(3)}, rel=4 * 1.04 / 64)
