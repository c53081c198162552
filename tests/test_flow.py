import json
import os
from pathlib import Path

import pytest

from tidemill.plans.flow import Flow, load_spec, run_flow
from tidemill.schema import SchemaMismatch
from tidemill.sinks.landed import LandedTable
from tidemill.streaming.ingest import drain

EXAMPLE = Path(__file__).resolve().parent.parent / "examples" / "orders.yml"

TWO_FLOWS = """
name: two-flows
description: keys that are not known are left alone
config: {anything: {goes: here}}
sources:
  - {type: file_csv, id: people, path: "%s/people.csv", has_header: true, batch_rows: 10}
  - {type: file_csv, id: things, path: "%s/things.csv"}
transforms:
  - {type: clean_data, id: tidy, trim_strings: true, normalize_case: title}
  - {type: sql_transform, id: young, query: "SELECT * FROM input_data WHERE age < 40", window_size: 0}
  - {type: sql_transform, id: old, query: "SELECT * FROM input_data WHERE age >= 40"}
  - {type: partition, id: keyed, partition_by: [col_0]}
  - {type: passthrough, id: same}
sinks:
  - {type: parquet_dir, id: young-files, path: "%s/out"}
  - {type: iceberg, id: old-table, table_name: old_people, bucket: lake, endpoint: x, access_key: x, secret_key: x, region: x}
  - {type: parquet_dir, id: thing-files, path: "%s/out"}
edges:
  - [people, tidy]
  - [tidy, young]
  - [tidy, old]
  - [young, young-files]
  - [old, old-table]
  - [things, keyed]
  - [keyed, same]
  - [same, thing-files]
"""


def test_fan_out_and_two_flows(spark, place):
    Path(place, "people.csv").write_text("id,name,age\n1, alice ,30\n2,bob,50\n3,carol x,40\n")
    Path(place, "things.csv").write_text("a,1\nb,2\n")
    done = run_flow(spark, TWO_FLOWS % (place, place, place, place), warehouse=place + "/wh")
    young = spark.read.parquet(done["young-files"]).collect()
    assert [(r["id"], r["name"]) for r in young] == [(1, "Alice")]
    assert done["old-table"] == f"{place}/wh/lake/old_people"
    old = LandedTable(spark, done["old-table"]).read()
    assert sorted((r["id"], r["name"]) for r in old.collect()) == [(2, "Bob"), (3, "Carol X")]
    things = spark.read.parquet(done["thing-files"])
    assert sorted(r["partition_key"] for r in things.collect()) == ["a", "b"]
    assert done["queries"] == []


def flow(edges, transforms=("a", "b")):
    return {
        "name": "f",
        "sources": [{"type": "file_csv", "id": "s", "path": "x"}],
        "transforms": [{"type": "passthrough", "id": t} for t in transforms],
        "sinks": [{"type": "stdout_pretty", "id": "o"}],
        "edges": edges,
    }


def test_wrong_wiring_is_refused():
    with pytest.raises(ValueError, match="unknown id nowhere"):
        Flow(flow([["s", "nowhere"]]))
    with pytest.raises(ValueError, match="cycle"):
        Flow(flow([["s", "a"], ["a", "b"], ["b", "a"]]))
    with pytest.raises(ValueError, match="duplicate id a"):
        Flow(flow([], ("a", "a")))


def test_without_edges_all_sources_feed_the_line_and_it_feeds_all_sinks(spark, place):
    assert Flow(flow([])).order == ["s", "a", "b", "o"]
    spec = flow([])
    spec["sources"].append({"type": "file_csv", "id": "t", "path": "x"})
    spec["sinks"] = [{"type": "parquet_dir", "id": "o", "path": place}, {"type": "parquet_dir", "id": "p", "path": place}]
    done = run_flow(spark, spec, inputs={"s": spark.range(3), "t": spark.range(3, 8)})
    for sink in "op":
        assert sorted(r.id for r in spark.read.parquet(done[sink]).collect()) == list(range(8))


def test_what_a_flow_cannot_do_is_refused(spark):
    spec = flow([["s", "a"], ["a", "o"]], ())
    window = lambda i: {"type": "sql_transform", "id": i, "query": "SELECT * FROM input_data", "window_size": 5}
    spec["transforms"] = [window("a"), window("b")]
    with pytest.raises(ValueError, match="unites rows of different windows"):
        Flow({**spec, "edges": [["s", "a"], ["s", "o"], ["a", "o"]]})
    with pytest.raises(ValueError, match="window of the windows"):
        Flow({**spec, "edges": [["s", "a"], ["a", "b"], ["b", "o"]]})
    topic = {**flow([]), "sources": [{"type": "kafka", "id": "s", "brokers": "x:1", "group_id": "g", "topic": "t"}]}
    with pytest.raises(ValueError, match="checkpoint"):
        run_flow(spark, topic, inputs={}, reader=lambda s, o: s.readStream.format("rate").load().selectExpr("'' AS value"))


def test_shared_steps_run_once(spark, place):
    """Two sinks behind one step see the same random numbers."""
    spec = flow([["s", "q"], ["q", "o"], ["q", "p"]], ())
    spec["transforms"] = [{"type": "sql_transform", "id": "q", "query": "SELECT id, rand() AS r, current_timestamp() AS at FROM input_data"}]
    spec["sinks"] = [{"type": "parquet_dir", "id": "o", "path": place}, {"type": "parquet_dir", "id": "p", "path": place}]
    done = run_flow(spark, spec, inputs={"s": spark.range(20)})
    a, b = (sorted(map(tuple, spark.read.parquet(done[s]).collect())) for s in "op")
    assert a == b


def test_iceberg_sink_writes_to_a_catalog(spark, place):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS flows LOCATION '{place}/db'")
    spec = flow([["s", "o"]], ())
    spec["sinks"] = [{"type": "iceberg", "id": "o", "catalog": "spark_catalog", "bucket": "flows", "table_name": "t"}]
    try:
        for _ in range(2):
            done = run_flow(spark, spec, inputs={"s": spark.range(3)})
        assert done["o"] == "spark_catalog.flows.t" and spark.table(done["o"]).count() == 6
    finally:
        spark.sql("DROP DATABASE flows CASCADE")


def test_several_parents_are_united(spark, place):
    spec = flow([["s", "a"], ["t", "a"], ["a", "o"]], ("a",))
    spec["sources"].append({"type": "file_csv", "id": "t", "path": "x"})
    spec["sinks"] = [{"type": "parquet_dir", "id": "o", "path": place}]
    one, two = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2 AS x, 'y' AS z")
    done = run_flow(spark, spec, inputs={"s": one, "t": two})
    assert sorted(tuple(r) for r in spark.read.parquet(done["o"]).select("x").collect()) == [(1,), (2,)]


def test_unknown_types_are_refused(spark):
    for group, entry in (
        ("sources", {"type": "ftp", "id": "s"}),
        ("transforms", {"type": "magic", "id": "a"}),
        ("sinks", {"type": "fax", "id": "o"}),
    ):
        spec = flow([["s", "a"], ["a", "o"]], ("a",))
        spec[group] = [entry]
        inputs = {} if group == "sources" else {"s": spark.range(1)}
        with pytest.raises(ValueError, match="unknown"):
            run_flow(spark, spec, inputs=inputs)


def test_every_transform_type_runs(spark, place, capfd):
    spec = {
        "name": "all",
        "sources": [{"type": "file_csv", "id": "s", "path": "x"}],
        "transforms": [
            {"type": "passthrough", "id": "p"},
            {"type": "json_flatten", "id": "f"},
            {"type": "schema_evolution", "id": "e", "auto_infer": True},
            {"type": "partition", "id": "k", "partition_by": ["a_b"], "partition_format": "<{0}>"},
            {"type": "clean_data", "id": "c", "remove_nulls": True},
            {"type": "sql_transform", "id": "q", "query": "SELECT partition_key FROM input_data"},
        ],
        "sinks": [{"type": "stdout_pretty", "id": "o"}, {"type": "parquet_dir", "id": "d", "path": place}],
        "edges": [["s", "p"], ["p", "f"], ["f", "e"], ["e", "k"], ["k", "c"], ["c", "q"], ["q", "o"], ["q", "d"]],
    }
    source = spark.sql("SELECT named_struct('b', 'v') AS a UNION ALL SELECT named_struct('b', CAST(NULL AS STRING))")
    done = run_flow(spark, spec, inputs={"s": source})
    assert [r[0] for r in spark.read.parquet(done["d"]).collect()] == ["<v>"]
    assert "<v>" in capfd.readouterr().out


def evolving(**step):
    spec = flow([["s", "a"], ["a", "o"]], ())
    spec["transforms"] = [{"type": "schema_evolution", "id": "a", **step}]
    return spec


def test_declared_schema_in_a_flow(spark, place):
    spec = evolving(strict_mode=True, schema={"fields": [{"name": "x", "data_type": "int64"}]})
    with pytest.raises(SchemaMismatch):
        run_flow(spark, spec, inputs={"s": spark.sql("SELECT 'a' AS x")})
    spec = evolving(schema={"fields": [{"name": "x", "data_type": "float64"}, {"name": "y", "data_type": "string"}]})
    spec["sinks"] = [{"type": "parquet_dir", "id": "o", "path": place}]
    run_flow(spark, spec, inputs={"s": spark.sql("SELECT 1 AS x, 2 AS z")})
    assert tuple(spark.read.parquet(place + "/o.parquet").select("x", "y").first()) == (1.0, None)


def test_schema_steps_remember_between_runs(spark, place):
    first, second = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2.5D AS x, 'n' AS y")
    run_flow(spark, evolving(strict_mode=True), inputs={"s": first}, checkpoint=place + "/a")
    run_flow(spark, evolving(strict_mode=True), inputs={"s": first}, checkpoint=place + "/a")
    with pytest.raises(SchemaMismatch):
        run_flow(spark, evolving(strict_mode=True), inputs={"s": second}, checkpoint=place + "/a")
    spec = evolving(auto_infer=True)
    spec["sinks"] = [{"type": "parquet_dir", "id": "o", "path": place}]
    for df in (first, second, first):
        done = run_flow(spark, spec, inputs={"s": df}, checkpoint=place + "/b")
    assert tuple(spark.read.parquet(done["o"]).select("x", "y").first()) == (1.0, None)


def messages(folder, name, rows):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_example_flow_over_topics(spark, place):
    """The example, fed from files; run twice, the second time with nothing new."""
    spec = load_spec(EXAMPLE)
    spec["sinks"][1]["path"] = place + "/doubtful"
    spec["sources"][2]["topic_mapping"]["dead_letters"] = place + "/dead"
    messages(place + "/web-orders", "0.json", [
        {"order_id": 1, "region": " North ", "pieces": 2, "price": 4.5}, {"order_id": 2, "region": "South", "pieces": 0, "price": 1.0},
    ])
    messages(place + "/shop-orders", "0.json", [{"order_id": 3, "region": "SOUTH", "pieces": 1, "price": 2.0}])
    messages(place + "/returns", "0.json", [{"order_id": 1, "reason": "Torn", "day": "2024-01-02"}, [1]])

    def reader(session, options):
        return session.readStream.text(f"{place}/{options['subscribe']}")

    for _ in range(2):
        done = run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/check", reader=reader)
        for query in done["queries"]:
            drain(query)
    orders = LandedTable(spark, done["orders-table"]).read().collect()
    assert sorted((r["order_id"], r["partition_key"], r["total"]) for r in orders) == [(1, "north", 9.0), (3, "south", 2.0)]
    assert [r["order_id"] for r in spark.read.parquet(done["doubtful-files"]).collect()] == [2]
    returned = LandedTable(spark, done["returns"]).read().collect()
    assert [(r["order_id"], r["reason"], str(r["day"])) for r in returned] == [(1, "torn", "2024-01-02")]
    assert [r["reason"] for r in spark.read.json(place + "/dead").collect()] == ["not an object"]


def test_two_sinks_of_a_stream_into_one_table(spark, place):
    messages(place + "/t", "0.json", [{"a": 1}, {"a": 2}, {"a": 3}])
    spec = {
        "name": "both",
        "sources": [{"type": "kafka", "id": "in", "brokers": "x:1", "group_id": "g", "topic": "t"}],
        "transforms": [
            {"type": "sql_transform", "id": "low", "query": "SELECT * FROM input_data WHERE a < 2"},
            {"type": "sql_transform", "id": "high", "query": "SELECT * FROM input_data WHERE a >= 2"},
        ],
        "sinks": [{"type": "iceberg", "id": i, "table_name": "one", "bucket": "b"} for i in ("x", "y")],
        "edges": [["in", "low"], ["in", "high"], ["low", "x"], ["high", "y"]],
    }
    done = run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/c", reader=lambda s, o: s.readStream.text(place + "/t"))
    drain(done["queries"][0])
    assert sorted(r["a"] for r in LandedTable(spark, done["x"]).read().collect()) == [1, 2, 3]


def test_rows_go_on_behind_a_mapped_topic(spark, place):
    messages(place + "/t", "0.json", [{"a": 1}, {"a": 2}])
    source = {
        "type": "kafka", "id": "in", "brokers": "x:1", "group_id": "g", "topic": "t",
        "topic_mapping": {"iceberg_table": "m", "bucket": "b", "sql_transform": "SELECT a, a * 2 AS twice FROM input_data WHERE a > 1"},
    }
    spec = {
        "name": "onward", "sources": [source],
        "transforms": [{"type": "sql_transform", "id": "q", "query": "SELECT twice + 1 AS more FROM input_data"}],
        "sinks": [{"type": "parquet_dir", "id": "out", "path": place + "/out"}],
        "edges": [["in", "q"], ["q", "out"]],
    }
    done = run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/c", reader=lambda s, o: s.readStream.text(place + "/t"))
    drain(done["queries"][0])
    assert [r["more"] for r in spark.read.parquet(done["out"]).collect()] == [5]
    assert [r["twice"] for r in LandedTable(spark, done["in"]).read().collect()] == [4]


def test_topic_mapping_in_a_flow(spark, place):
    messages(place + "/t", "0.json", [{"a": 1, "day": "2024-01-01"}, {"a": 2, "day": "2024-01-02"}])
    spec = {
        "name": "mapped",
        "sources": [
            {
                "type": "kafka", "id": "in", "brokers": "x:1", "group_id": "g", "topic": "t",
                "topic_mapping": {
                    "iceberg_table": "mapped", "bucket": "lake", "auto_schema_evolution": True,
                    "sql_transform": "SELECT *, DATE(day) AS partition_date FROM input_data WHERE a > 1",
                    "partition_by": ["partition_date"],
                },
            }
        ],
        "transforms": [], "sinks": [], "edges": [],
    }
    done = run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/c",
                    reader=lambda s, o: s.readStream.text(place + "/t"))
    drain(done["queries"][0])
    assert [r["a"] for r in LandedTable(spark, done["in"]).read().collect()] == [2]


def test_topic_to_files_in_a_flow(spark, place):
    """Row numbers over a stream: each micro-batch goes through the whole flow."""
    messages(place + "/t", "0.json", [{"a": 1}, {"a": 2}])
    spec = {
        "name": "files",
        "sources": [{"type": "kafka", "id": "in", "brokers": "x:1", "group_id": "g", "topic": "t"}],
        "transforms": [
            {"type": "sql_transform", "id": "q", "query": "SELECT a, ROW_NUMBER() OVER (ORDER BY a DESC) AS n FROM input_data"}
        ],
        "sinks": [{"type": "parquet_dir", "id": "out", "path": place + "/out"}],
    }
    for _ in range(2):
        done = run_flow(spark, spec, checkpoint=place + "/c", reader=lambda s, o: s.readStream.text(place + "/t"))
        drain(done["queries"][0])
    assert sorted((r["a"], r["n"]) for r in spark.read.parquet(done["out"]).collect()) == [(1, 2), (2, 1)]


def counting(place, size, **sink):
    """A topic whose rows are counted once per ``size`` files, and also written as they come."""
    return {
        "name": "windows",
        "sources": [{"type": "kafka", "id": "s", "brokers": "x:1", "group_id": "g", "topic": "t"}],
        "transforms": [
            {"type": "sql_transform", "id": "w", "window_size": size,
             "query": "SELECT min(batch) AS first, max(batch) AS last, count(*) AS n FROM input_data"},
        ],
        "sinks": [{"type": "iceberg", "id": "o", "table_name": "counts", **sink}, {"type": "parquet_dir", "id": "p", "path": place}],
        "edges": [["s", "w"], ["w", "o"], ["s", "p"]],
    }


def batches(place, first, last):
    Path(place).mkdir(exist_ok=True)
    for k in range(first, last):
        Path(place, f"{k}.json").write_text("".join(json.dumps({"batch": k, "row": i}) + "\n" for i in range(k + 1)))
        os.utime(f"{place}/{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))


def by_file(place):
    return lambda spark, options: spark.readStream.option("maxFilesPerTrigger", 1).text(place)


def test_windows_of_batches_in_a_flow(spark, place):
    spec = counting(place + "/out", 3)
    rows = lambda: sorted(map(tuple, LandedTable(spark, done["o"]).read().select("first", "last", "n").collect()))
    run = lambda: run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/check", reader=by_file(place + "/in"))
    batches(place + "/in", 0, 4)
    done = run()
    for query in done["queries"]:
        drain(query)
    assert rows() == [(0, 2, 6)]  # the fourth batch waits
    batches(place + "/in", 4, 7)  # a restart inside the window
    done = run()
    done["finish"]()
    assert rows() == [(0, 2, 6), (3, 5, 15), (6, 6, 7)]
    done["finish"]()
    assert rows() == [(0, 2, 6), (3, 5, 15), (6, 6, 7)]
    assert spark.read.parquet(done["p"]).count() == 28


def test_a_window_that_is_handed_on_again_counts_once(spark, place, monkeypatch):
    """The window's load is written, then the query dies before the window is closed."""
    spec = counting(place + "/out", 2)
    batches(place + "/in", 0, 3)
    run = lambda: run_flow(spark, spec, warehouse=place + "/wh", checkpoint=place + "/check", reader=by_file(place + "/in"))
    from tidemill.streaming.count_window import BatchBuffer

    with monkeypatch.context() as patched:
        patched.setattr(BatchBuffer, "done", lambda self, number: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()["finish"]()
    done = run()
    done["finish"]()
    got = LandedTable(spark, done["o"]).read().select("first", "last", "n").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 3), (2, 2, 3)]


def test_a_replayed_batch_leaves_one_copy_in_a_catalog_table(spark, place, monkeypatch):
    spark.sql(f"CREATE DATABASE replays LOCATION '{place}/db'")
    spec = {**counting(place + "/out", 1, catalog="spark_catalog", bucket="replays"), "edges": [["s", "o"]], "transforms": []}
    spec["sinks"] = spec["sinks"][:1]
    batches(place + "/in", 0, 3)
    run = lambda: run_flow(spark, spec, checkpoint=place + "/check", reader=by_file(place + "/in"))
    from tidemill.plans import flow as flows

    write = flows.append_to_catalog

    def crash(*given):
        write(*given)
        raise RuntimeError("lost after the write")

    try:
        with monkeypatch.context() as patched:
            patched.setattr(flows, "append_to_catalog", crash)
            with pytest.raises(Exception, match="lost after the write"):
                run()["finish"]()
        done = run()
        done["finish"]()
        assert done["o"] == "spark_catalog.replays.counts"
        assert sorted((r["batch"], r["row"]) for r in spark.table(done["o"]).collect()) == [(k, i) for k in range(3) for i in range(k + 1)]
    finally:
        spark.sql("DROP DATABASE replays CASCADE")
