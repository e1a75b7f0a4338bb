"""Operators against plain-Python brute force on small random fixtures, both ways of each."""

import random
from datetime import date, datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from txflow.operators import fold, quantiles, recon, rolling
from txflow.operators.graph import Graph, flatten, merchant_fanout
from txflow.plans.anomaly import amount_anomalies
from txflow.plans.bursts import burst_members, burst_rows, short_bursts
from txflow.plans.report import daily_report, read_report, write_report
from txflow.skew import Limits, heavy_keys, lookup

T0 = datetime(2024, 1, 1)
WAYS = [Limits(), Limits(rows=3), Limits(rows=3, most=2)]  # ordinary keys; nearly all keys heavy; too many to collect


def payments(seed, n=160, cards=5, spread=1500, merchants=3, micros=True):
    """Dense payments; some at the same instant, some linked to two merchants, one third on one card."""
    rng, rows, times = random.Random(seed), [], []
    for i in range(n):
        card = "c0" if rng.random() < 0.34 else f"c{rng.randrange(cards)}"
        step = rng.uniform(0, spread) if micros else rng.randrange(spread)
        ts = rng.choice(times) if times and rng.random() < 0.15 else T0 + timedelta(seconds=step)
        times.append(ts)
        amount = round(rng.uniform(0, 9), 2)
        links = rng.sample(range(merchants), 2 if rng.random() < 0.1 else 1)
        rows += [(f"t{i}", None if i % 37 == 5 else ts, card, f"m{m}", f"k{i % 4}", amount) for m in links]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "trans_num string, ts timestamp, cardholder_id string, merchant_id string, "
                                       "category string, amount double")


@pytest.mark.parametrize("limits", WAYS)
@pytest.mark.parametrize(("seconds", "micros"), [(60, False), (600, True)])
def test_velocity(spark, limits, seconds, micros):
    rows = payments(seconds + micros, micros=micros)
    got = {(r.trans_num, r.merchant_id): r.tx_last_10m
           for r in rolling.velocity(frame(spark, rows), seconds, limits).collect()}
    want = {}
    for num, ts, card, merchant, *_ in rows:
        want[num, merchant] = 0 if ts is None else len({
            r[0] for r in rows if r[2] == card and r[1] and ts - timedelta(seconds=seconds) < r[1] <= ts})
    assert got == want


def companions(rows, seconds, timed=True):
    found = set()
    for a in rows:
        for b in rows:
            if a[2] == b[2] and a[0] != b[0] and a[3] != b[3] and a[1] and b[1]:
                if not timed or abs((a[1] - b[1]) / timedelta(microseconds=1)) < (seconds + 1) * 1_000_000:
                    found.add((a[2], a[0]))
    return found


@pytest.mark.parametrize("limits", WAYS)
@pytest.mark.parametrize(("seconds", "mode"), [(0, "intent"), (20, "intent"), (20, "as_written")])
def test_burst_members(spark, limits, seconds, mode):
    rows = payments(seconds, n=120, spread=3000)
    small = [r for r in rows if r[5] <= 5]
    got = burst_members(frame(spark, rows), seconds=seconds, mode=mode, limits=limits).collect()
    assert {(r.cardholder_id, r.trans_num) for r in got} == companions(small, seconds, mode == "intent")


@pytest.mark.parametrize("limits", [Limits(), Limits(3)])
def test_burst_rows_and_lists_agree(spark, limits):
    rows = payments(11, n=200, spread=400)
    whole = {r.cardholder: r for r in short_bursts(frame(spark, rows), limits=limits).collect()}
    single = burst_rows(frame(spark, rows), limits=limits).collect()
    for card, r in whole.items():
        ids = sorted(x.trans_num for x in single if x.cardholder == card)
        assert ids == r.suspiciousTransactions and len(ids) == r.burstCount >= 3
    assert {x.cardholder for x in single} == set(whole) and whole


def test_per_burst_runs(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(f"t{i}", at(s), "c", f"m{i % 2}", "k", 1.0) for i, s in enumerate([0, 300, 900, 5000, 5100])]
    out = short_bursts(frame(spark, rows), per_burst=True, min_size=2).orderBy("burstStart").collect()
    assert [(r.burstStart, r.burstCount) for r in out] == [(at(0), 3), (at(5000), 2)]


def interpolated(values, p):
    values = sorted(values)
    x = p * (len(values) - 1)
    low, share = values[int(x)], x - int(x)
    return low if share == 0 else low + (values[int(x) + 1] - low) * share


@pytest.mark.parametrize("limits", WAYS)
def test_quantiles(spark, limits):
    rng = random.Random(3)
    rows = [(f"k{i % 6}", rng.choice([0.0, -1e-9, 1e12, round(rng.gauss(0, 50), 2), rng.gauss(0, 1e-3)]))
            for i in range(400)] + [("one", 4.5), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = (0.0, 0.25, 0.99)
    got = {r.k: (r.n, r.q) for r in quantiles.quantiles(df, "k", "v", probs, limits).collect()}
    assert set(got) == {k for k, v in rows if k and v is not None}
    for k, (n, q) in got.items():
        values = [v for x, v in rows if x == k and v is not None]
        assert n == len(values) and q == pytest.approx([interpolated(values, p) for p in probs], rel=1e-12)
    one = quantiles.quantiles(df, None, "v", (0.5,), limits).first()
    assert one.q[0] == pytest.approx(median(v for _, v in rows if v is not None))


@pytest.mark.parametrize("limits", WAYS)
def test_median_and_mad(spark, limits):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(5)}", round(rng.expovariate(0.1), 2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v double")
    for r in quantiles.median_and_mad(df, "k", "v", 5, limits).collect():
        values = [v for k, v in rows if k == r.k]
        assert (r.n, r.med) == (len(values), pytest.approx(median(values)))
        assert r.mad == pytest.approx(median(abs(v - median(values)) for v in values))


def test_heavy_keys_are_few_and_lookup_is_complete(spark):
    rows = [("hot", i) for i in range(60)] + [(f"k{i}", i) for i in range(30)] + [(None, i) for i in range(50)]
    left = spark.createDataFrame(rows, "k string, i int")
    right = spark.createDataFrame([("hot", "H"), ("k3", "three"), (None, "never")], "k string, v string")
    heavy = heavy_keys(left, "k", Limits(rows=20))
    assert [r.k for r in heavy.keys.collect()] == ["hot"] and heavy.nulls
    joined = lookup(left, right, heavy)
    assert joined.count() == 140 and joined.where("v = 'H'").count() == 60 and joined.where("v = 'never'").count() == 0
    assert lookup(left, right, heavy, how="inner").count() == 61
    none = heavy_keys(left, "k", Limits(rows=1000))
    assert none.keys is None and lookup(left, right, none).count() == 140
    many = heavy_keys(left, "k", Limits(rows=1, most=1))
    assert not many.few and many.nulls and [r.k for r in many.keys.collect()] == ["hot"]  # a stored table
    assert lookup(left, right, many).where("v = 'H'").count() == 60


def sequential(rows):
    """Create-or-update, one sighting after the other."""
    store = {}
    for s in sorted(rows, key=lambda r: r["seq"]):
        t = store.get(s["trans_num"])
        if t is None:
            t = store[s["trans_num"]] = {"source": s["source"], "ts": s["ts"], "amount": s["amount"],
                                         "is_fraud": s["is_fraud"], "city": s["city"], "state": s["state"],
                                         "ingested_at": s["ingested_at"], "updated_at": None, "category": None,
                                         "channel": None, "file": None, "city_pop": None, "job": None}
            if s["source"] == "batch":
                t.update(city_pop=s["city_pop"], file=s["file"])
            else:
                t.update(category=s["category"], channel=s["channel"], job=s["job"])
            continue
        t["updated_at"], t["amount"] = s["ingested_at"], s["amount"]
        if s["source"] == "batch":
            t.update(ts=s["ts"], is_fraud=s["is_fraud"], file=s["file"])
        else:
            t.update(category=s["category"], channel=s["channel"], state=s["state"])
    return store


SIGHTING = ("trans_num string, source string, seq long, ts timestamp, amount double, is_fraud int, category string, "
            "channel string, city string, state string, city_pop int, lat double, long double, latitude double, "
            "longitude double, cardholder_lat double, cardholder_long double, merchant_lat double, merchant_long double,"
            "job string, dob string, cardholder_id string, merchant_id string, file string, ingested_at timestamp")
NAMES = [part.split()[0] for part in SIGHTING.split(",")]


def sightings(seed, n=300, keys=50):
    rng, out = random.Random(seed), []
    for seq in range(n):
        kind = rng.choice(["batch", "kafka"])
        maybe = lambda v: None if rng.random() < 0.2 else v
        r = dict.fromkeys(NAMES)
        r |= {"trans_num": f"t{rng.randrange(keys)}", "source": kind, "seq": seq, "ts": T0 + timedelta(hours=seq),
              "amount": maybe(float(seq)), "is_fraud": maybe(seq % 2), "city": maybe(f"city{seq}"),
              "state": maybe(f"s{seq}"), "ingested_at": T0 + timedelta(days=1, seconds=seq)}
        if kind == "batch":
            r |= {"city_pop": seq, "lat": 1.0, "file": maybe(f"f{seq}")}
        else:
            card = rng.randrange(6)
            r |= {"category": maybe(f"k{seq}"), "channel": "POS", "job": maybe(f"j{seq}"), "dob": f"d{card}",
                  "cardholder_id": f"c{card}", "merchant_id": f"m{rng.randrange(4)}", "merchant_lat": float(seq)}
        out.append(r)
    return out


def sighting_frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], SIGHTING)


@pytest.mark.parametrize("seed", [1])
def test_fold_equals_sequential_upserts_in_any_order(spark, seed):
    rows = sightings(seed)
    want = sequential(rows)

    def check(state):
        got = {r.trans_num: r.asDict() for r in fold.transactions(state).collect()}
        assert set(got) == set(want)
        for key, record in want.items():
            assert {f: got[key][f] for f in record} == record

    check(fold.fold_state(sighting_frame(spark, rows)))
    random.Random(seed).shuffle(rows)
    parts = [fold.fold_state(sighting_frame(spark, rows[i::3])) for i in range(3)]
    check(fold.merge_states(fold.merge_states(parts[2], parts[0]), parts[1]))


def test_entities_edges_and_flatten(spark):
    rows = sightings(9)
    linked = [r for r in rows if r["cardholder_id"]]
    graph = Graph.of(sighting_frame(spark, rows))
    cards = {r.cardholder_id: r for r in graph.cardholders.collect()}
    for card, r in cards.items():
        own = [x for x in linked if x["cardholder_id"] == card]
        assert r.job == next((x["job"] for x in own if x["job"]), None) and r.dob == own[0]["dob"]
        assert r.updated_at == (own[-1]["ingested_at"] if len(own) > 1 else None)
    merchants = {r.merchant_id: r.latitude for r in graph.merchants.collect()}
    assert merchants == {m: next(x["merchant_lat"] for x in linked if x["merchant_id"] == m) for m in merchants}
    pairs = {(r["cardholder_id"], r["trans_num"]) for r in linked}
    assert {tuple(r) for r in graph.performed.collect()} == pairs
    paths = {(c, t, r["merchant_id"]) for c, t in pairs for r in linked if r["trans_num"] == t}
    for limits in WAYS:
        flat = flatten(graph, None, limits).collect()
        assert len(flat) == len(paths) and len(flat[0]) == 16
    top = flatten(graph, 7).collect()
    assert [r.trans_num for r in top] == [r.trans_num for r in flatten(graph, None).collect()][:7]
    fan = merchant_fanout(sighting_frame(spark, linked)).collect()
    assert [r.merchantCount for r in fan] == sorted(
        (len({x["merchant_id"] for x in linked if x["cardholder_id"] == c}) for c in cards), reverse=True)


def test_reconciliation(spark):
    rows = sightings(4)
    df = sighting_frame(spark, rows)
    by = {kind: {r["trans_num"] for r in rows if r["source"] == kind} for kind in ("batch", "kafka")}
    assert {r.transNum for r in recon.batch_only(df).collect()} == by["batch"] - by["kafka"]
    assert {r.transNum for r in recon.stream_only(df).collect()} == by["kafka"] - by["batch"]
    extra = {r.source: r.extra for r in recon.duplicate_counts(df).collect()}
    assert extra == {k: sum(r["source"] == k for r in rows) - len(by[k]) for k in by}
    assert recon.ingest_lag(df, 3).first().ingestLagSeconds == 86400 - min(
        r["seq"] * 3599 for r in rows if r["source"] == "kafka")


def test_report_has_verdicts_and_replaces_its_day(spark, folder):
    df = sighting_frame(spark, sightings(4))
    refused = spark.createDataFrame([("batch", "CastMismatch", ["amt"], T0 + timedelta(days=1))],
                                    "source string, error_type string, failed_fields array<string>, "
                                    "ingested_at timestamp")
    report = daily_report(df, refused, date(2024, 1, 2), {"records": 1000.0, "duplicates": 0.0})
    for _ in range(2):
        write_report(report, folder)
    write_report(daily_report(df, refused, date(2024, 1, 3)), folder)
    rows = read_report(spark, folder).where("dt = '2024-01-02'").collect()
    status = {(r.metric, r.dimension): r.status for r in rows}
    assert len(status) == len(rows)
    assert status["records", "batch"] == "PASS" and status["duplicates", "kafka"] == "FAIL"
    assert status["field_mismatch", "batch/CastMismatch/amt"] is None and status["summary", "all"] == "FAIL"


def test_report_counts_sightings_of_any_source(spark):
    day = date(2024, 1, 2)
    at = datetime(2024, 1, 2)
    rows = [("a", "batch"), ("a", "kafka"), ("b", "batch"), ("c", "kafka"), ("c", "kafka"), ("d", "upload"), ("d", "upload"),
            ("d", "batch"), ("e", None), ("e", None), ("e", None), (None, "upload"), (None, "batch")]
    seen = spark.createDataFrame([(n, s, at, at) for n, s in rows],
                                 "trans_num string, source string, ts timestamp, ingested_at timestamp")
    refused = spark.createDataFrame([], "source string, error_type string, failed_fields array<string>, ingested_at timestamp")

    def told(df):
        rows = daily_report(df, refused, day).collect()
        counts = ("records", "duplicates", "batch_only", "stream_only")
        return {(r.metric, r.dimension): r.value for r in rows if r.metric in counts}

    assert told(seen) == {
        ("records", "batch"): 4.0, ("records", "kafka"): 3.0, ("records", "upload"): 3.0, ("records", None): 3.0,
        ("duplicates", "kafka"): 1.0, ("duplicates", "upload"): 1.0, ("duplicates", None): 2.0,
        ("batch_only", "all"): 2.0, ("stream_only", "all"): 1.0}
    assert told(seen.limit(0)) == {("batch_only", "all"): 0.0, ("stream_only", "all"): 0.0}


def scores(rows, min_card=5, min_cat=30):
    """The cascade in plain Python: trans_num -> (baseline, raw score)."""
    def base(values):
        if not values:
            return None
        m = median(values)
        return m, median(abs(v - m) for v in values)

    out = {}
    for num, _, card, _, category, amount in rows:
        own = [r[5] for r in rows if r[2] == card and r[5] is not None]
        alike = [r[5] for r in rows if category is not None and r[4] == category and r[5] is not None]
        used, (m, mad) = (("cardholder", base(own)) if len(own) >= min_card else
                          ("category", base(alike)) if len(alike) >= min_cat else
                          ("global", base([r[5] for r in rows if r[5] is not None])))
        unit = 1e-9 if mad == 0 else max(mad, 0.25)
        out[num] = used, None if amount is None else min(abs(amount - m) / unit, 25)
    return out


@pytest.mark.parametrize("limits", WAYS)
def test_anomaly_cascade(spark, limits):
    rng, rows = random.Random(8), []
    for i in range(150):
        card = "busy" if i < 50 else "flat" if i < 57 else f"c{i % 30}"
        amount = 7.0 if card == "flat" and i != 56 else None if i % 40 == 3 else round(rng.expovariate(0.02), 2)
        rows.append((f"t{i}", T0 + timedelta(seconds=60 * i), card, "m", ("big", "small", None)[min(i % 4, 2)], amount))
    tx = frame(spark, rows)
    want = scores(rows)
    assert {u for u, _ in want.values()} == {"cardholder", "category", "global"}
    got = amount_anomalies(tx, tx, tx, limit=None, limits=limits).collect()
    assert {r.trans_num: r.baseline_used for r in got} == {k: u for k, (u, _) in want.items()}
    for r in got:
        assert r.raw_score == (None if want[r.trans_num][1] is None else pytest.approx(want[r.trans_num][1]))
    if limits != Limits():
        return
    strict = {r.trans_num for r in amount_anomalies(tx, limit=None, mode="as_written").collect()}
    size = lambda i, v: sum(r[i] == v and r[5] is not None for r in rows)
    assert strict == {r[0] for r in rows if size(2, r[2]) >= 5 and r[4] and size(4, r[4]) >= 30}
    top = amount_anomalies(tx, limit=10).collect()
    assert top[0].combined_score is None  # scores that are unknown come first
    since = amount_anomalies(tx, limit=None, since="2024-01-01 01:00:00")
    assert since.count() == sum(r[1] >= T0 + timedelta(hours=1) for r in rows)


def test_everyday_plan_shuffles_payments_once(spark):
    tx = frame(spark, payments(1))
    plan = rolling.velocity(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(cardholder_id") == 1 and "Python" not in plan


def test_grid_join_meets_every_pair_once(spark):
    from txflow.skew import Limits, grid_join

    left = spark.range(900).selectExpr("if(id < 600, 'hot', concat('k', id % 40)) as k", "id as a").unionByName(
        spark.createDataFrame([(None, 1), ("left", 2)], "k string, a long"))
    right = spark.range(700).selectExpr("if(id < 400, 'hot', concat('k', id % 50)) as k", "id as b").unionByName(
        spark.createDataFrame([(None, 1)], "k string, b long"))
    right = right.unionByName(right.limit(5))  # repeated rows stay repeated
    expected = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    for limits in (Limits(), Limits(rows=50), Limits(rows=5), Limits(rows=5, most=2)):
        assert sorted(map(tuple, grid_join(left, right, "k", limits).select("k", "a", "b").collect())) == expected
    # The hot key's pairs are not all made by one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = grid_join(left, right, "k", Limits(rows=50)).where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(made) > 1 and max(r["count"] for r in made) < sum(r["count"] for r in made) / 2
