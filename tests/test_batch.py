import gzip
import json
import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from txflow.operators import canonical
from txflow.plans.load import Stores, load_batch, run_load
from txflow.schemas import BATCH_PAYLOAD, CANONICAL
from txflow.session import scratch_dir
from txflow.sinks import landing, quarantine
from txflow.sinks.store import GraphStore
from txflow.sources import files

AS_OF = datetime(2024, 6, 1, 12)
ROW = {
    "index": "1", "trans_date_trans_time": "2023-07-21 14:25:00", "Client Name": "Al, Jo", "transaction type": "grocery",
    "amt": "45.67", "city": "Austin", "state": "TX", "lat": "30.2", "long": "-97.7", "city_pop": "964254",
    "job": "Engineer", "dob": "1989-03-12", "trans_num": "A1", "latitude": "30.3", "longitude": "-97.8", "is_fraud": "0",
}


def row(**values):
    return {**ROW, **values}


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if path.name.endswith((".gz", ".gzip")) else text.encode())


def csv_text(rows, names):
    quote = lambda v: '"' + str(v).replace('"', '""') + '"'
    return "\n".join([",".join(quote(n) for n in names)] + [",".join(quote(r[n]) for n in names) for r in rows]) + "\n"


@pytest.fixture
def inputs(tmp_path):
    """Every layout and defect the readers must cope with."""
    base = tmp_path / "in"
    put(base / "plain.csv", csv_text([row(), row(trans_num="A2", trans_date_trans_time="03/01/2019 14:13")], list(ROW)))
    put(base / "deep/er/shuffled.csv.gz", csv_text([row(trans_num="A3")], list(ROW)[::-1]))
    other = {"transaction_id": "A4", " txn_amount ": "9.5", "trans_date": "24-07-2023", "isFraud": "yes",
             "client_name": 'Said "hi"', "city": "Rome"}
    put(base / "other.csv", csv_text([other], list(other)))
    put(base / "empty.csv", "")
    put(base / "wrong.csv.gzip", csv_text([row(trans_num="LOST")], list(ROW)))
    defects = [
        row(trans_num="J1", amt=120.5, is_fraud="yes"), row(trans_num="J2", amt="N/A"),
        row(trans_num="J3", city_pop="CHICAGO"), row(trans_num="J4", amt="-15.75", lat="not_a_number"),
        row(trans_num="J5", amt=None), row(trans_num="J6", latitude="thirty"), row(trans_num="J7", extra_field="x"),
        row(trans_num="J8", lat="", long="", city_pop="", job="", dob="", latitude="", longitude=""),
        row(trans_num="J9", amt="free"), row(trans_num="J10", trans_date_trans_time="32/01/2020"),
        row(trans_num=None, amt=None),
    ]
    lines = [json.dumps(d) for d in defects]
    lines[1:1] = ["{broken", "", '[{"trans_num":"L1","amount":3,"trans_date":"2020-01-01"}]']
    lines.append(json.dumps({"transNum": "P1", " amt ": 7, "trans_date": "2020-01-01", "nested": {"a": 1}}))
    put(base / "lines.jsonl", "\n".join(lines) + "\n")
    put(base / "more.ndjson.gz", json.dumps(row(trans_num="N1")) + "\n")
    put(base / "pretty.json", json.dumps([row(trans_num="Z1"), row(trans_num="Z2", amt=5)], indent=2))
    put(base / "single.json", json.dumps({"trans_num": "Z3", "amount": 4.5, " trans_date ": "2020-01-02"}, indent=2))
    put(base / "notes.txt", "ignored")
    return base


def keyed(frame):
    return {r["trans_num"]: r for r in frame.collect()}


def test_csv_files_are_read_by_their_own_header(spark, inputs):
    rows = keyed(canonical.canonicalise(files.read_csv(spark, str(inputs))))
    assert set(rows) == {"A1", "A2", "A3", "A4"}
    assert rows["A3"]["city"] == "Austin" and rows["A3"]["Client Name"] == "Al, Jo"
    assert rows["A4"]["amt"] == "9.5" and rows["A4"]["Client Name"] == 'Said "hi"' and rows["A4"]["dob"] is None
    assert rows["A3"]["file"].endswith("deep/er/shuffled.csv.gz")


def test_one_scan_per_layout(spark, tmp_path):
    for i in range(6):
        put(tmp_path / f"f{i}.csv", csv_text([row(trans_num=str(i))], list(ROW) if i % 2 else list(ROW)[::-1]))
    plan = files.read_csv(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


def test_headers_equal_after_trimming_fill_each_other(spark, tmp_path):
    put(tmp_path / "a.csv", "trans_num, amt,amt \nA,,5\nB,6,\n")
    rows = keyed(files.read_csv(spark, str(tmp_path)))
    assert (rows["A"]["amt"], rows["B"]["amt"]) == ("5", "6")


def test_jsonl(spark, inputs):
    rows = files.read_jsonl(spark, str(inputs)).collect()
    found = {r["trans_num"] or r["transNum"]: r for r in rows}
    assert found["P1"]["amt"] == "7" and found["L1"]["amount"] == "3" and found["N1"]["city"] == "Austin"
    assert [r["unreadable"] for r in rows if r["unreadable"]] == ["{broken"]


def test_pretty_json(spark, inputs):
    rows = keyed(files.read_json(spark, str(inputs)))
    assert set(rows) == {"Z1", "Z2", "Z3"} and rows["Z2"]["amt"] == "5" and rows["Z3"]["trans_date"] == "2020-01-02"


def test_pretty_json_of_odd_forms(spark, tmp_path):
    put(tmp_path / "a.json", '\ufeff\n [ {"trans_num": "A", "amt": 1.5, "job": {"a": [1, "x"]}},\n null, {" amt ": 12345678901234567890} ]')
    put(tmp_path / "b.json", '{"trans_num": "B",\n "amt": ')
    put(tmp_path / "c.json", "[]")
    put(tmp_path / "d.json", " \n\t\n")
    put(tmp_path / "e.json", "{}")
    put(tmp_path / "f.json", "7")
    put(tmp_path / "g.json", '\n{"trans_num": "G", "amt": true}')
    got = [(Path(r["file"]).stem, r["trans_num"] or "", r["amt"], r["job"], r["unreadable"])
           for r in files.read_json(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([
        ("a", "", None, None, "null"), ("a", "", "12345678901234567890", None, None),
        ("a", "A", "1.5", '{"a":[1,"x"]}', None), ("b", "", None, None, '{"trans_num": "B",\n "amt": '),
        ("e", "", None, None, None), ("f", "", None, None, "7"), ("g", "G", "true", None, None)], key=str)


def test_pretty_json_is_scanned_once(spark, inputs):
    rows = files.read_json(spark, str(inputs))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_no_task_holds_a_whole_pretty_file(spark, tmp_path, monkeypatch):
    flat = [{"trans_num": f"F{i}", "amt": i, "job": 'said "é", [1]'} for i in range(300)]
    deep = [{"trans_num": f"D{i}", "job": {"a": [{"b": "}"}, {}]}, "city": '\\"}{ \\', "amt": i} for i in range(300)]
    put(tmp_path / "flat.json", json.dumps(flat, indent=2, ensure_ascii=False))
    put(tmp_path / "line.json", json.dumps(flat))
    put(tmp_path / "deep.json", json.dumps(deep, indent=2))
    put(tmp_path / "deep.json.gz", json.dumps(deep) + "\n")
    monkeypatch.setattr(files, "_whole_files", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = files.read_json(spark, str(tmp_path)).select(
            "trans_num", "job", "city", "amt", "unreadable", F.element_at(F.split("file", "/"), -1).alias("name"),
            F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [(r.name, r.trans_num, r.job, r.city, int(r.amt)) for r in rows]
    assert sorted(got) == sorted(
        [(n, r["trans_num"], r["job"], None, r["amt"]) for n in ("flat.json", "line.json") for r in flat]
        + [(n, r["trans_num"], '{"a":[{"b":"}"},{}]}', r["city"], r["amt"]) for n in ("deep.json", "deep.json.gz") for r in deep])
    assert not any(r.unreadable for r in rows) and len({r.task for r in rows if r.name == "flat.json"}) > 4


def test_pretty_files_that_end_badly_give_no_records(spark, tmp_path):
    good = json.dumps([{"trans_num": "A"}, {"trans_num": "B"}])
    deep = json.dumps([{"trans_num": "A"}, {"job": {"a": 1}}])
    bad = {"open": good[:-1], "torn": good[:-2], "deep": deep[:-1], "tail": '{"job": [{"a": 1}, {"b": 2}]', "only": '{"trans_num": "C"',
           "middle": good.replace("}, {", "} {"), "word": good.replace('"B"', "tru")}
    for name, text in bad.items():
        put(tmp_path / f"{name}.json", text)
        put(tmp_path / f"{name}_packed.json.gz", text)
    put(tmp_path / "good.json", good)
    rows = [(Path(r.file).name.split(".")[0], r.trans_num, r.unreadable) for r in files.read_json(spark, str(tmp_path)).collect()]
    wanted = [(name + end, None, text) for name, text in bad.items() for end in ("", "_packed")]
    assert sorted(rows, key=str) == sorted([("good", "A", None), ("good", "B", None), *wanted], key=str)


def test_manifest_tells_what_is_not_read(spark, inputs):
    errors = {Path(r["path"]).name: r["error"] for r in files.manifest(spark, str(inputs)).collect()}
    assert errors["wrong.csv.gzip"] and errors["plain.csv"] is None and "empty.csv" not in errors


def test_unreadable_files_are_told(spark, tmp_path):
    put(tmp_path / "good.csv", csv_text([row()], list(ROW)))
    (tmp_path / "latin.csv").write_bytes("trans_num,amt,größe\nL1,5,x\n".encode("latin-1"))
    (tmp_path / "torn.csv.gz").write_bytes(gzip.compress(csv_text([row(trans_num="T")] * 500, list(ROW)).encode())[:-300][:40])
    errors = {Path(r.path).name: r.error for r in files.manifest(spark, str(tmp_path), opened=True).collect()}
    assert errors["torn.csv.gz"] and errors["good.csv"] is None and errors["latin.csv"] is None
    with pytest.raises(ValueError, match="torn.csv.gz"):
        files.read_csv(spark, str(tmp_path))
    with pytest.warns(UserWarning, match="torn.csv.gz"):
        rows = keyed(files.read_csv(spark, str(tmp_path), on_error="skip"))
    assert set(rows) == {"A1", "L1"} and rows["L1"]["amt"] == "5"


def test_files_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    """Tasks can't open the scheme; the header comes from Spark's reader."""
    put(tmp_path / "a.csv", csv_text([row()], list(ROW)))
    put(tmp_path / "deep" / "b.csv.gz", csv_text([row(trans_num="A2")], list(ROW)[::-1]))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.far.link./in", f"file://{tmp_path}")
    rows = keyed(files.read_csv(spark, "viewfs://far/in"))
    assert set(rows) == {"A1", "A2"} and rows["A2"]["city"] == "Austin"


def test_a_wrong_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "nowhere"))


def test_nothing_to_read(spark, tmp_path):
    put(tmp_path / "a.txt", "x")
    with pytest.raises(ValueError, match="no readable"):
        files.read_all(spark, str(tmp_path))


EXPECTED_BAD = {
    "J2": ["amt"], "J3": ["city_pop"], "J4": ["lat"], "J5": ["amt"], "J6": ["latitude"], "J9": ["amt"],
    "J10": ["trans_date_trans_time"], None: ["trans_num", "amt"],
}
EXPECTED_GOOD = {"A1", "A2", "A3", "A4", "J1", "J7", "J8", "L1", "P1", "N1", "Z1", "Z2", "Z3"}


def test_load_splits_clean_and_rejected(spark, inputs):
    clean, bad = load_batch(spark, str(inputs), AS_OF)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in BATCH_PAYLOAD]
    good = {r["transNum"]: r for r in clean.collect()}
    assert set(good) == EXPECTED_GOOD
    assert good["J1"]["isFraud"] == 1 and good["J8"]["lat"] is None and good["A4"]["isFraud"] == 1
    assert good["A2"]["tsEpoch"] == 1551449580
    rows = bad.collect()
    broken = [r for r in rows if r.error_type == "JSONDecodeError"]
    assert [r.raw_record for r in broken] == ["{broken"]
    found = {json.loads(r.raw_record)["trans_num"]: r.failed_fields for r in rows if r not in broken}
    assert found == EXPECTED_BAD
    assert set(json.loads(next(r for r in rows if r not in broken).raw_record)) == {*CANONICAL, "file"}


def test_run_load_is_repeatable(spark, inputs, folder):
    stores = Stores.under(folder)
    for _ in range(2):
        counts = run_load(spark, str(inputs), stores, "day1", AS_OF, include_ids=True, writers=2)
        assert counts == {"records": len(EXPECTED_GOOD) + len(EXPECTED_BAD) + 1, "rejected": len(EXPECTED_BAD) + 1}
    seen = landing.sightings(landing.read_landing(spark, stores.landing))
    assert {r.trans_num for r in seen.collect()} == EXPECTED_GOOD and seen.count() == len(EXPECTED_GOOD)
    assert seen.where(F.length("cardholder_id") == 64).count() == len(EXPECTED_GOOD)
    assert quarantine.read(spark, stores.quarantine).count() == len(EXPECTED_BAD) + 1
    days = {p.name for p in Path(stores.quarantine).glob("source=batch/*")}
    assert days == {"ingest_date=2024-06-01"}
    assert list(Path(stores.quarantine).rglob("*.json.gz"))


def test_a_load_leaves_only_its_last_rejects(spark, tmp_path, folder):
    stores = Stores.under(folder)
    put(tmp_path / "in.jsonl", json.dumps(row(amt="NaN")) + "\n" + json.dumps(row(amt="Infinity")) + "\n")
    put(tmp_path / "other.jsonl", json.dumps(row(amt="x")) + "\n")
    for day in (1, 2):
        run_load(spark, str(tmp_path / "in.jsonl"), stores, "a", datetime(2024, 6, day))
    run_load(spark, str(tmp_path / "other.jsonl"), stores, "b", datetime(2024, 6, 2))
    kept = quarantine.read(spark, stores.quarantine).collect()
    assert sorted((r.batch_id, str(r.ingest_date), r.failed_fields[0]) for r in kept) == [
        ("a", "2024-06-02", "amt"), ("a", "2024-06-02", "amt"), ("b", "2024-06-02", "amt")]
    put(tmp_path / "in.jsonl", json.dumps(row()) + "\n")
    run_load(spark, str(tmp_path / "in.jsonl"), stores, "a", datetime(2024, 6, 3))
    assert [r.batch_id for r in quarantine.read(spark, stores.quarantine).collect()] == ["b"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        """A session on a cluster whose shared folder is not set."""

        master = "yarn"
        conf = {}

        @property
        def sparkContext(self):  # noqa: N802
            return self

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Cluster(), "x")


def test_landing_parses_the_input_once(spark, inputs):
    rows = landing.from_batch(canonical.validate(canonical.canonicalise(files.read_jsonl(spark, str(inputs)))),
                              F.current_timestamp())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_few_writers_need_no_shuffle(spark, tmp_path, folder, monkeypatch):
    for i in range(12):
        lines = [json.dumps(row(trans_num=f"{i}-{j}", amt="x" if j % 3 else "5")) for j in range(30)]
        put(tmp_path / f"in/{i}.jsonl", "\n".join(lines) + "\n")
    rows = landing.from_batch(canonical.validate(canonical.canonicalise(files.read_jsonl(spark, str(tmp_path / "in")))),
                              F.lit(AS_OF)).repartition(12)
    monkeypatch.setattr(type(rows), "repartition", None)
    for _ in range(2):
        landing.write_batch(rows, folder, "batch", "a", writers=2)
    written = landing.read_landing(spark, folder)
    assert {r.trans_num for r in written.collect()} == {f"{i}-{j}" for i in range(12) for j in range(30)}
    assert {(r.rejected, r["count"]) for r in written.groupBy("rejected").count().collect()} == {(False, 120), (True, 240)}
    found = [p.parent.name for p in Path(folder).rglob("*.parquet")]
    assert all(1 <= found.count(f"rejected={v}") <= 2 for v in ("true", "false")) and len(found) <= 4


def test_plenty_of_rejects_are_written_as_they_are_read(spark, folder, monkeypatch):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("trans_num"), *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in landing.LANDING.fields if f.name not in ("trans_num", "rejected")])
    rows = rows.withColumns({"rejected": F.lit(True), "raw_record": F.col("trans_num"), "ingested_at": F.lit(AS_OF), "batch_id": F.lit("a"),
                             "ingest_date": F.lit(AS_OF).cast("date"), "source": F.lit("batch")}).repartition(8)
    landing.write_batch(rows.drop("batch_id"), f"{folder}/landing", "batch", "a")
    rejects = quarantine.from_landing(landing.read_landing(spark, f"{folder}/landing"))
    monkeypatch.setattr(quarantine, "PLENTY", 500)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        for count, least, most in ((4000, 8, 8), (3999, 1, 7), (None, 1, 7)):
            quarantine.replace(rejects, f"{folder}/quarantine", "batch", "a", count)
            assert least <= len(list(Path(folder, "quarantine").rglob("*.json.gz"))) <= most
            kept = quarantine.read(spark, f"{folder}/quarantine").collect()
            assert sorted(int(r.raw_record) for r in kept) == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stored_graph_takes_loads_one_by_one(spark, tmp_path, folder):
    stores = Stores.under(folder, graph=True)
    store = GraphStore(spark, stores.graph, buckets=2)
    assert store.buckets == GraphStore(spark, stores.graph).buckets == 2  # as first written

    def load(name, day, *numbers, **values):
        put(tmp_path / name / "in.jsonl", "\n".join(json.dumps(row(trans_num=n, **values)) for n in numbers) + "\n")
        return run_load(spark, str(tmp_path / name), stores, name, datetime(2024, 6, day), include_ids=True)

    assert load("a", 1, "1", "2")["created"] == 2
    assert {k: v for k, v in load("b", 2, "2", "3", amt="9").items() if k in ("total", "created", "updated")} == {
        "total": 2, "created": 1, "updated": 1}
    assert load("b", 2, "2", "3", amt="9")["updated"] == 1  # again: replaces itself
    amounts = {r.trans_num: (r.amount, r.updated_at is not None) for r in store.graph().transactions.collect()}
    assert amounts == {"1": (45.67, False), "2": (9.0, True), "3": (9.0, False)}
    store.compact()
    assert store.generation() == 1 and store.holds("a") and not store.holds("c")
    load("c", 3, "1", amt="7")
    amounts = {r.trans_num: (r.amount, r.updated_at is not None) for r in store.graph().transactions.collect()}
    assert amounts == {"1": (7.0, True), "2": (9.0, True), "3": (9.0, False)}
    with pytest.raises(ValueError, match="base"):
        load("a", 4, "1")
    assert store.graph().performed.count() == 3


def test_stored_graph_is_read_without_a_shuffle(spark, folder):
    from txflow.operators import graph

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    seen = spark.range(60).selectExpr(
        "cast(id % 40 as string) as trans_num", "if(id % 2 = 0, 'batch', 'kafka') as source", "id as seq",
        "timestamp_seconds(id) as ts", "timestamp_seconds(id) as ingested_at", "cast(id as double) as amount", "'c' as category",
        "'p' as channel", "'x' as city", "'y' as state", "0 as is_fraud", "1 as city_pop", "'j' as job", "'d' as dob",
        "concat('h', id % 7) as cardholder_id", "concat('m', id % 5) as merchant_id", "'f' as file",
        *[f"0d as {c}" for c in ("lat", "long", "latitude", "longitude", "cardholder_lat", "cardholder_long", "merchant_lat", "merchant_long")])
    store = GraphStore(spark, folder, buckets=4)
    expected = {}
    for load, which in (("01", "seq < 30"), ("1.0", "seq >= 30"), ("it's", "seq % 3 = 0")):
        store.apply(seen.where(which), load)
        expected[load] = sorted(map(str, graph.payments(store.graph()).collect()))
        assert "Exchange" not in plan(graph.payments(store.graph()))
    assert sorted(store.loads()) == ["01", "1.0", "it's"]
    store.apply(seen.where("false"), "it's")  # again, with nothing in it
    assert store.stats("01") == {"total": 30, "created": 30, "updated": 0}
    assert store.stats("1.0") == {"total": 30, "created": 10, "updated": 20}
    assert sorted(map(str, graph.payments(store.graph()).collect())) == expected["1.0"]
    store.compact()
    assert sorted(map(str, graph.payments(store.graph()).collect())) == expected["1.0"]
    merged = plan(store.graph().transactions)
    assert "Exchange" not in merged and "Aggregate" not in merged


def test_micro_batches_are_gathered(spark, inputs, folder):
    stores = Stores.under(folder)
    for name in ("q-1", "q-2", "other"):
        run_load(spark, str(inputs), stores, name, AS_OF)
    before = landing.read_landing(spark, stores.landing).count()
    for expected in (2, 0):
        assert landing.compact(spark, stores.landing, "batch", "day", "q-") == expected
        rows = landing.read_landing(spark, stores.landing)
        assert rows.count() == before and {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {"day", "other"}


def test_batches_that_arrive_between_two_compactions_are_kept(spark, inputs, folder):
    stores = Stores.under(folder)

    def land(*names):
        for name in names:
            run_load(spark, str(inputs), stores, name, AS_OF)

    def compact(into="day", prefix="q-"):
        return landing.compact(spark, stores.landing, "batch", into, prefix)

    def held():
        rows = landing.read_landing(spark, stores.landing).groupBy("batch_id").count().collect()
        return {r.batch_id: r["count"] for r in rows}

    land("q-1", "q-2")
    each = held()["q-1"]
    assert compact() == 2
    land("q-3")
    assert compact() == 1 and held() == {"day": 2 * each, "day.2": each}
    assert compact() == 0 and sum(held().values()) == 3 * each
    # Stopped before the old folders went: a copy that the note names is only removed, a newer one is refused.
    land("q-4")
    kept = Path(stores.landing, "source=batch", "batch_id=q-4")
    shutil.copytree(kept, Path(folder, "copy"))
    assert compact() == 1
    shutil.copytree(Path(folder, "copy"), kept)
    assert compact() == 1 and held() == {"day": 2 * each, "day.2": each, "day.3": each}
    land("q-4")
    with pytest.raises(ValueError, match="q-4"):
        compact()
    assert held()["q-4"] == each
    # A batch that is only called like the result is not taken for it.
    land("load", "p-1")
    with pytest.raises(ValueError, match="load"):
        compact("load", "p-")
    assert held()["p-1"] == each


def test_filters_of_a_load_repeat_no_casts(spark, inputs):
    for rows in load_batch(spark, str(inputs), AS_OF):
        plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [line for line in plan if "Filter" in line.split("(")[0] and "try_cast" in line]
        assert any("CollectMetrics" in line for line in plan)


def test_raw_files_of_one_row_group_are_written_by_many_tasks(spark, folder):
    from txflow.registry.queries import _raw_files
    from txflow.registry.views import table

    rows = spark.range(200_000).selectExpr(
        "id as l_orderkey", "xxhash64(id) as l_partkey", "xxhash64(id, 1) as l_suppkey", "1 as l_linenumber", "cast(id % 50 as double) as l_quantity",
        "'A' as l_returnflag", "timestamp_ntz '1995-01-01 00:00:00' as l_shipdate")
    rows.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    assert table(spark, folder, "lineitem").rdd.getNumPartitions() <= 8
    written = spark.read.option("header", "true").csv(_raw_files(spark, folder))
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 200_000 and len(sizes) > 1 and max(sizes) < 150_000


def test_tables_of_many_row_groups_are_not_dealt_anew(spark, folder):
    from txflow.registry.views import RAW, view

    rows = spark.range(640).selectExpr(
        "id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber", "cast(id % 50 as double) as l_quantity",
        "'A' as l_returnflag", "timestamp_ntz '1995-01-01 00:00:00' as l_shipdate")
    for parts, dealt in ((64, False), (1, True)):
        rows.repartition(parts).write.parquet(f"{folder}/{parts}/lineitem.parquet")
        spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
        try:
            got = view(spark, f"{folder}/{parts}", RAW, spread=True)
            plan = got._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert ("RebalancePartitions" in plan) == dealt and got.count() == 640
