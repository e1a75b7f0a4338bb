"""Baselines counted load by load."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txflow.operators.quantiles import median_and_mad
from txflow.plans.anomaly import amount_anomalies
from txflow.sinks.baselines import Baselines
from txflow.skew import DEFAULT, Limits


def plain(rows):
    return sorted(map(str, rows.collect()))


def some_payments(spark, begin, end):
    i = F.col("id")
    return spark.range(begin, end).select(
        i.cast("string").alias("trans_num"),
        F.when(i % 53 > 0, F.timestamp_seconds(1_717_200_000 + i * 1_700)).alias("ts"),
        F.when(i % 31 > 0, (i % 9).cast("string")).alias("cardholder_id"), (i % 4).cast("string").alias("merchant_id"),
        F.when(i % 11 > 0, (i % 3).cast("string")).alias("category"),
        F.when(i % 37 == 0, float("nan")).when(i % 41 > 0, (i * i % 97) / 4).alias("amount"))


@pytest.mark.parametrize("limits", [DEFAULT, Limits(rows=5)])
@pytest.mark.parametrize("key", [None, "k"])
def test_weighted_medians_equal_those_of_the_rows(spark, limits, key):
    rows = spark.range(400).select(F.when(F.col("id") % 50 > 0, F.col("id") % 3).alias("k"), (F.col("id") * 7 % 23 - 5.0).alias("v"))
    counts = rows.groupBy("k", "v").agg(F.count("*").alias("n"))
    assert plain(median_and_mad(counts, key, "v", limits=limits, weight="n")) == plain(median_and_mad(rows, key, "v", limits=limits))


def test_loads_add_up_to_their_payments(spark, folder):
    base, every = Baselines(spark, folder), some_payments(spark, 0, 300)
    assert base.anomalies().isEmpty() and base.payments(datetime(2024, 6, 3)).isEmpty()
    wrong = some_payments(spark, 100, 140).withColumn("amount", F.lit(3.5)).withColumn("category", F.lit("x"))
    base.add(some_payments(spark, 0, 100), "01")
    base.add(some_payments(spark, 0, 20).withColumn("ts", F.lit(datetime(2030, 1, 1))), "a/b=c *")
    base.add(wrong, "a/b=c *")  # a second attempt at the load, on other days
    base.add(some_payments(spark, 100, 300), "2024-06-01", replaced=wrong)
    whole = amount_anomalies(every, limit=None)
    assert plain(base.anomalies(limit=None)) == plain(whole)
    assert plain(base.anomalies(limit=None, limits=Limits(rows=5))) == plain(whole)
    since = datetime(2024, 6, 4, 0, 5)
    assert plain(base.anomalies(since, limit=None)) == plain(amount_anomalies(every, limit=None, since=str(since)))


def test_scoring_since_a_time_opens_no_older_days(spark, folder):
    base = Baselines(spark, folder)
    base.add(some_payments(spark, 0, 300), "1")
    opened = base.payments(datetime(2024, 6, 4)).inputFiles()
    assert opened and all("2024-06-04" <= name.split("period=")[1][:10] <= "2024-06-06" for name in opened)
    scored = base.anomalies(datetime(2024, 6, 4, 0, 5), limit=None)
    read = [name for name in scored.inputFiles() if "/payments/" in name]
    assert read and all(name.split("period=")[1][:10] >= "2024-06-03" for name in read)


@pytest.mark.parametrize("since", [None, datetime(2024, 6, 4, 0, 5)])
def test_scoring_adds_amounts_up_once(spark, folder, since):
    base = Baselines(spark, folder)
    base.add(some_payments(spark, 0, 300), "1")
    base.add(some_payments(spark, 300, 400), "2", replaced=some_payments(spark, 0, 20))
    read = base.anomalies(since, limit=None).inputFiles()
    assert any("/payments/" in name for name in read)
    assert not any(part in name for name in read for part in ("/categories/", "/cardholders/"))


def test_payments_taken_back_count_for_no_heavy_key(spark, folder, monkeypatch):
    from txflow.plans import anomaly

    seen = {}
    found = anomaly.heavy_keys
    monkeypatch.setattr(anomaly, "heavy_keys", lambda df, key, *more: seen.setdefault(key, df) and found(df, key, *more))
    base, wrong = Baselines(spark, folder), some_payments(spark, 0, 40)
    base.add(some_payments(spark, 0, 100), "1")
    base.add(some_payments(spark, 100, 200), "2", replaced=wrong)
    scored = base.anomalies(limit=None)
    for key, table in (("category", "categories"), ("cardholder_id", "cardholders")):
        rows = base.payments().select(key).unionByName(base.amounts(table).select(key)).groupBy(key).count()
        assert plain(seen[key].groupBy(key).agg(F.sum("rows").alias("count"))) == plain(rows)
    assert scored.count() == base.payments().count()
