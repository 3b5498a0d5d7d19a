"""What bounds a task's share: partitions by the input's size, narrow shuffles, no table of the listing's length through the driver."""

import contextlib
import datetime as dt
import glob
import io
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from punctuo import fixtures as fx
from punctuo import session
from punctuo import sinks
from punctuo.operators import dims as D
from punctuo.operators import fptf as P
from punctuo.operators import normalise as N
from punctuo.operators import segments as S
from punctuo.plans import fold as FO

T0 = dt.datetime(2024, 1, 1)


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ADVISORY, SCAN, PARTITIONS = "spark__sql__adaptive__advisoryPartitionSizeInBytes", "spark__sql__files__maxPartitionBytes", "spark__sql__shuffle__partitions"


def test_tasks_are_sized_by_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(session, "PARTITION_INPUT_BYTES", 100)
    get = lambda k: spark.conf.get(k.replace("__", "."))
    with settings(spark, **{ADVISORY: "64MB", SCAN: "128MB", PARTITIONS: "4"}):
        session.size_tasks(spark, str(tmp_path))
        assert int(get(PARTITIONS)) > 20 and session._bytes(get(ADVISORY)) == 8 << 20 and session._bytes(get(SCAN)) == 16 << 20
    with settings(spark, **{ADVISORY: "1m", SCAN: "2m", PARTITIONS: "900"}):  # a caller's finer settings stay
        session.size_tasks(spark, str(tmp_path))
        assert (get(PARTITIONS), get(ADVISORY), get(SCAN)) == ("900", "1m", "2m")
    with settings(spark, **{ADVISORY: "64MB", SCAN: "128MB", PARTITIONS: "4"}):
        entry.queries()["freeze_threshold"](spark, "/root/testdata/sf0.001")
        assert session._bytes(get(ADVISORY)) == 8 << 20


def test_batches_are_found_without_broadcasts(spark):
    files = spark.createDataFrame([(f"f{i:02d}", T0 + dt.timedelta(hours=7 * i), T0 + dt.timedelta(hours=7 * i + 6)) for i in range(40)],
                                  "path string, first timestamp_ntz, last timestamp_ntz")
    text = plan(S.greedy_batches(files))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_versions_are_written_by_many_tasks(spark, tmp_path):
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        fx.write_timetables(spark, "/root/testdata/sf0.001", str(tmp_path))
    folders = glob.glob(f"{tmp_path}/stop_times/gtfs_version=*")
    assert len(folders) == 3 and all(len(glob.glob(f"{f}/*.parquet")) == 4 for f in folders)


def test_only_narrow_calls_are_dealt_out_for_documents(spark):
    text = plan(fx.fptf_documents(spark, "/root/testdata/sf0.001"))
    assert "Window" not in text  # neighbours come from a trip's array
    kept = [c.name for c in fx._trip_calls(spark, "/root/testdata/sf0.001").schema["c"].dataType.elementType.fields]
    assert kept == ["stop_sequence", "arrival_s", "departure_s", "delay", "p"]


def test_boards_deal_a_call_out_once(spark, tmp_path):
    d = str(tmp_path)
    tables = {"lineitem": ([(0, 1, 2, 5), (0, 6, 3, 7), (0, 2, 2, 9)], "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long"),
              "orders": ([(0, 7)], "o_orderkey long, o_custkey long"), "part": ([(7,)], "p_partkey long"),
              "supplier": ([(2, "A"), (3, "B")], "s_suppkey long, s_name string"), "nation": ([(7, "N")], "n_nationkey long, n_name string")}
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{d}/{name}.parquet")
    with settings(spark, spark__sql__adaptive__enabled="false"):
        df = fx.fptf_documents(spark, d).where("type in ('departures', 'arrivals')")
        text = plan(df)
    assert text.count("+- Exchange hashpartitioning(stop_id") == 1 and len(re.findall(r"ReusedExchange \[stop_id#\d+, _h", text)) == 1
    # the call at stop 3 arrives at 05:59 and leaves at 06:00; stop 2's at 05:10 and 05:20 (trips leave at 18000 s and 600 s a line)
    got = {r.response_key: r.doc for r in df.collect()}
    assert sorted(got) == ["a2@2024010105", "a3@2024010105", "d2@2024010105", "d3@2024010106"]
    assert got["d2@2024010105"].count('"tripId"') == got["a2@2024010105"].count('"tripId"') == 2
    assert '"plannedWhen":"2024-01-01T05:59:00Z"' in got["a3@2024010105"] and '"plannedWhen":"2024-01-01T06:00:00Z"' in got["d3@2024010106"]


def test_queries_on_documents_have_more_partitions(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(session, "PARTITION_INPUT_BYTES", 100)
    n = {}
    for query in ("final_delay", "fptf_samples"):
        with settings(spark, **{ADVISORY: "64MB", SCAN: "128MB", PARTITIONS: "4"}):
            session.size_tasks(spark, str(tmp_path), query)
            n[query] = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 4 * n["final_delay"] - 4 < n["fptf_samples"] <= 4 * n["final_delay"]


def test_stations_of_a_response_come_once(spark):
    stop = '{"type":"stop","id":"1","name":"A","station":{"type":"station","id":"9","name":"B"}}'
    entry_ = f'{{"tripId":"t","stop":{stop},"plannedWhen":"2024-01-01T00:00:00Z"}}'
    docs = spark.createDataFrame([("r", "departures", f"[{entry_},{entry_}]"), ("r", "departures", f"[{entry_}]"), ("q", "departures", f"[{entry_}]"),
                                  ("l", "locations", f"[{stop},{stop}]")], "response_key string, type string, doc string")
    got = sorted((r.response_key, r.station_id) for r in P.fptf_stations(docs).collect())
    assert got == [("l", "1"), ("l", "9"), ("q", "1"), ("q", "9"), ("r", "1"), ("r", "9")]


def test_a_filter_on_samples_copies_no_parsing(spark):
    entry_ = '{"tripId":"t","stop":{"type":"stop","id":"1"},"plannedWhen":"2024-01-01T00:00:00Z"}'
    obj = lambda at: f'{{"departures":[{entry_}],"realtimeDataUpdatedAt":{at}}}'
    docs = spark.createDataFrame([("r", "departures", obj(1704067200 - 3600)), ("old", "departures", obj(1)), ("q", "departures", f"[{entry_}]")],
                                 "response_key string, type string, doc string")
    s = P.fptf_samples(docs.withColumn("doc", F.trim("doc"))).drop("stations")
    rel = N.relevant(N.normalise(s.withColumn("response_ts", F.col("sample_time"))))
    assert [(r.response_key, r.ttl_minutes) for r in rel.collect()] == [("r", 60)]
    optimized = [df._jdf.queryExecution().optimizedPlan().toString() for df in (s, rel)]
    assert optimized[1].count("from_json(") == optimized[0].count("from_json(") and optimized[1].count("trim(") == optimized[0].count("trim(")


def test_dictionaries_neither_sort_nor_deal_out_the_values(spark):
    stored = spark.createDataFrame([("operator", 3, "O1", "old")], "dim string, id int, key string, name string")
    values = spark.createDataFrame([(1, "O1", "x"), (2, "O2", "b"), (3, "O2", "a"), (4, None, None)], "n int, operator string, operator_name string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        every, out = D.assign_all(stored, values, {"operator": "operator"}, {"operator": "operator_name"})
        text = plan(out)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert sorted((r.id, r.key, r.name) for r in every.collect()) == [(3, "O1", "old"), (4, "O2", "a")]
    assert sorted((r.n, r.operator_id) for r in out.collect()) == [(1, 3), (2, 4), (3, 4), (4, None)]


def test_load_counters_deal_samples_out_once(spark):
    rows = [(1, 1, "h1", "a", 5), (1, 2, "h1", "a", 5), (2, 3, "h2", "a", 5), (2, 4, "h2", "b", 5), (3, 5, None, "c", 5), (1, 6, "h1", "d", 9999)]
    norm = spark.createDataFrame(rows, "response_id int, sample_id bigint, hash string, v string, ttl_minutes int").withColumn("sample_time", F.lit(T0))
    stored = spark.createDataFrame([("h2",), ("h2",), (None,)], "hash string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        df = N.load_counters(norm, stored, ["v", "ttl_minutes"])
        text = plan(df)
    assert sorted(map(tuple, df.collect())) == [(1, 2, 1, 0, 1), (2, 2, 1, 1, 0), (3, 1, 0, 0, 1)]
    join, window = text.index("SortMergeJoin"), text.index("Window")
    assert "HashAggregate" in text[join:window]  # the log meets counts


def test_a_batch_writes_few_files_a_day(spark, tmp_path):
    sample = fx.sample(spark, "/root/testdata/sf0.001")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        FO.fold(spark, sample, fx.remarks(spark, "/root/testdata/sf0.001"), str(tmp_path))
    days = glob.glob(f"{tmp_path}/samples/part=*/day=*")
    assert len(days) > 20 and all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in days)
    assert FO.samples(spark, str(tmp_path)).count() == sample.drop("id").distinct().count()
    assert sinks.manifest(spark, str(tmp_path))["version"] == 1
