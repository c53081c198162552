"""Arrays that are read by many tasks equal those read by one."""

import glob
import json
import os
import random
from pathlib import Path

import pytest

from tidemill.plans import operator_queries
from tidemill.session import scratch_made, shared_root
from tidemill.sources.json_arrays import array_records, array_scan
from tidemill.sources.json_files import json_scan

ODD = ['}', '{', '"', '\\', '\\"', ']}', '},{', '[', "\n", "é字", "", " ", '\\\\"}', ","]


def objects(n, seed):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(ODD) for _ in range(rng.randrange(0, 8)))
    out = []
    for i in range(n):
        out.append({"id": i, "a": text(), "b": {"c": text(), "d": [{"e": text()}, {}, [1, {"x": {}}]] if i % 3 else []}})
        if i % 5 == 0:
            out[-1][text() + "}"] = {}
    return out


@pytest.mark.parametrize("indent", [None, 2])
def test_records_are_those_of_the_array(spark, place, indent):
    Path(place, "in").mkdir()
    files = {f"f{k}.json": objects(n, k) for k, n in enumerate((200, 1, 0, 57))}
    for name, rows in files.items():
        Path(place, "in", name).write_text(json.dumps(rows, indent=indent, ensure_ascii=False) + "\n" * (indent or 0))
    got = array_records(spark, place + "/in", range_bytes=300).collect()
    pieces = spark.read.parquet(max(glob.glob(f"{shared_root(spark)}/tidemill/json-pieces-*"), key=os.path.getmtime))
    assert pieces.select("file", "range").distinct().count() > 50
    found = {name: [] for name in files}
    for r in got:
        found[r.file.rsplit("/", 1)[1]].append(json.loads(r.value))
    for name, rows in files.items():
        assert sorted(found[name], key=lambda x: x["id"]) == rows


def test_scan_equals_the_read_by_one_task(spark, place):
    Path(place, "a.json").write_text(json.dumps([{"id": i, "t": ODD[i % len(ODD)], "n": {"x": i / 2}} for i in range(300)]))
    schema = json_scan(spark, place, "array").schema
    expected = sorted(map(str, json_scan(spark, place, "array", schema=schema).collect()))
    assert sorted(map(str, array_scan(spark, place, schema=schema, range_bytes=300).collect())) == expected
    assert sorted(r.n.x for r in array_scan(spark, place, range_bytes=200).collect()) == [i / 2 for i in range(300)]


def test_broken_arrays(spark, place):
    Path(place, "a.json").write_text('[{"id": 1}, 5, {"id": 2}, {"id": 3}, {"id": ')
    assert sorted(r.id for r in array_scan(spark, place, continue_on_error=True, range_bytes=10).collect()) == [1, 3]
    with pytest.raises(Exception, match="malformed JSON record"):
        array_scan(spark, place, schema=array_scan(spark, place, continue_on_error=True, range_bytes=10).schema).collect()


def test_written_arrays_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(operator_queries, "ARRAY_ROWS", 1000)
    rows = operator_queries.QUERIES["src4_split_array"](spark, "/root/testdata/sf0.01")
    assert rows.select("o_orderkey").distinct().count() == rows.count() == 15000
    written = [p for p in scratch_made() if "/json-arrays-" in p][-1]
    sizes = [len(json.loads(Path(f).read_text())) for f in glob.glob(f"{written}/*/*.txt")]
    assert len(sizes) == 15 and sum(sizes) == 15000 and max(sizes) < 1300
