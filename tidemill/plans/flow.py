"""Run a flow declared as YAML or a dict: sources, transforms, sinks and edges between their ids.

A flow is wired into lazily evaluated frames: Catalyst plans each sink's whole path as one query.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import register_functions
from ..operators.clean import clean_data, passthrough
from ..operators.flatten import json_flatten
from ..operators.partitioning import add_partition
from ..operators.sql import sql_transform
from ..schema import schema_evolution, schema_from_config
from ..session import pin_settings, scratch_path, shared_root
from ..sinks.files import parquet_dir, stdout_pretty
from ..sinks.landed import LandedTable, SchemaLog, append_to_catalog, evolve_to_log
from ..sources.csv_files import csv_scan
from ..sources.kafka import Reader, connector, kafka_stream
from ..streaming.count_window import BatchBuffer
from ..streaming.ingest import each_batch, query_id
from ..streaming.topic_table import TopicTable, parse_messages

Step = Callable[[DataFrame], DataFrame]
Gather = Callable[[str, DataFrame], DataFrame | None]


def load_spec(source: Mapping | str | Path) -> dict:
    """A spec given as a dict, as YAML text, or as the path of a YAML file."""
    if isinstance(source, Mapping):
        return dict(source)
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML needs PyYAML; pass a dict instead") from missing
    text = Path(source).read_text() if isinstance(source, Path) or "\n" not in str(source) else str(source)
    return yaml.safe_load(text)


def _evolve(df: DataFrame, entry: Mapping, registry: str | None) -> DataFrame:
    """Against the fields the entry declares, or against what earlier runs and batches registered."""
    options = (entry.get("auto_infer", False), entry.get("strict_mode", False))
    if entry.get("schema"):
        return schema_evolution(df, schema_from_config(entry["schema"]), *options)
    if registry is None:
        return df
    return evolve_to_log(df, SchemaLog(df.sparkSession, f"{registry}/{entry['id']}"), *options)


def _transform(entry: Mapping, registry: str | None) -> Step:
    kind = entry["type"]
    if kind == "passthrough":
        return passthrough
    if kind == "clean_data":
        return lambda df: clean_data(
            df,
            entry.get("remove_nulls", False),
            entry.get("trim_strings", False),
            entry.get("normalize_case"),
            entry.get("subset"),
        )
    if kind == "json_flatten":
        return lambda df: json_flatten(
            df, entry.get("separator", "_"), entry.get("max_depth", 5), entry.get("value")
        )
    if kind == "partition":
        return lambda df: add_partition(df, entry["partition_by"], entry.get("partition_format", ""))
    if kind == "schema_evolution":
        return lambda df: _evolve(df, entry, registry)
    if kind == "sql_transform":
        return lambda df: sql_transform(df, entry["query"])
    raise ValueError(f"unknown transform type {kind}")


@dataclass
class Flow:
    """A checked spec: every id is known and the edges have no cycle."""

    spec: dict
    nodes: dict[str, dict] = field(init=False)
    parents: dict[str, list[str]] = field(init=False)
    order: list[str] = field(init=False)
    windows: dict[str, str | None] = field(init=False)

    def __post_init__(self) -> None:
        self.nodes = {}
        for group in ("sources", "transforms", "sinks"):
            for entry in self.spec.get(group) or []:
                if entry["id"] in self.nodes:
                    raise ValueError(f"duplicate id {entry['id']}")
                self.nodes[entry["id"]] = {**entry, "group": group}
        edges = [tuple(edge) for edge in self.spec.get("edges") or []] or self._chain()
        self.parents = {name: [] for name in self.nodes}
        for start, end in edges:
            for name in (start, end):
                if name not in self.nodes:
                    raise ValueError(f"edge names unknown id {name}")
            self.parents[end].append(start)
        try:
            self.order = list(TopologicalSorter(self.parents).static_order())
        except CycleError as cycle:
            raise ValueError(f"edges form a cycle: {' -> '.join(cycle.args[1])}") from cycle
        self.windows = self._windows()

    def size_of(self, name: str) -> int:
        """How many batches a step gathers before it runs."""
        return int(self.nodes[name].get("window_size") or 1)

    def _windows(self) -> dict[str, str | None]:
        """For each node the step whose windows of batches its rows come in, if any.

        Rows that come batch by batch and rows that come window by window can't meet in one node:
        a load is one or the other, and is replaced as such.
        """
        found: dict[str, str | None] = {}
        for name in self.order:
            above = {found[p] for p in self.parents[name]}
            if len(above) > 1:
                raise ValueError(f"{name} unites rows of different windows: {sorted(map(str, above))}")
            found[name] = next(iter(above), None)
            if self.nodes[name]["group"] == "transforms" and self.size_of(name) > 1:
                if found[name] is not None:
                    raise ValueError(f"{name}: a window of the windows of {found[name]} is not supported")
                found[name] = name
        return found

    def _chain(self) -> list[tuple[str, str]]:
        """Without edges the transforms are one line: every source feeds the first of them and the last
        feeds every sink."""
        sources, steps, sinks = (self.group(g) for g in ("sources", "transforms", "sinks"))
        if not steps:
            return [(a, b) for a in sources for b in sinks]
        return [*((a, steps[0]) for a in sources), *zip(steps, steps[1:]), *((steps[-1], b) for b in sinks)]

    @property
    def evolves(self) -> bool:
        """Whether tables may change their schema where a sink does not say."""
        settings = (self.spec.get("config") or {}).get("processing") or {}
        return bool(settings.get("auto_schema_evolution", False))

    def behind(self, source: str) -> list[str]:
        """The sinks that a node's rows reach."""
        reached = {source}
        for name in self.order:
            if reached & set(self.parents[name]):
                reached.add(name)
        return [n for n in self.group("sinks") if n in reached]

    def group(self, name: str) -> list[str]:
        return [n for n, entry in self.nodes.items() if entry["group"] == name]

    def frames(
        self, inputs: Mapping[str, DataFrame], registry: str | None = None, gather: Gather | None = None
    ) -> dict[str, DataFrame]:
        """The frame of every node that some input reaches; several parents are united by name.
        ``registry`` is the folder schema steps remember their schemas in. ``gather`` takes the rows
        that reach a step with a window of batches, and gives those of the window once it is full;
        without it the rows are the whole window.

        A node that several others read is written to the shared folder once: it is computed once
        for all sinks behind it, which so get the same times and the same rows.
        """
        built: dict[str, DataFrame] = {}
        readers = Counter(p for parents in self.parents.values() for p in parents)
        for name in self.order:
            if name in inputs:
                built[name] = _once(inputs[name], name) if readers[name] > 1 else inputs[name]
                continue
            arriving = [built[p] for p in self.parents[name] if p in built]
            if not arriving:
                continue
            df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), arriving)
            entry = self.nodes[name]
            if gather is not None and self.windows[name] == name:
                df = gather(name, df)
                if df is None:
                    continue
            df = _transform(entry, registry)(df) if entry["group"] == "transforms" else df
            built[name] = _once(df, name) if readers[name] > 1 else df
        return built


def _once(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of this run in the shared folder."""
    path = scratch_path(df.sparkSession, f"flow-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table_root(spark: SparkSession, entry: Mapping, warehouse: str | None) -> str:
    base = warehouse or f"{shared_root(spark)}/tidemill/warehouse"
    return f"{base.rstrip('/')}/{entry.get('bucket', 'default')}/{entry['table_name']}"


def _catalog_name(entry: Mapping) -> str:
    return f"{entry['catalog']}.{entry.get('bucket', 'default')}.{entry['table_name']}"


def _write(
    df: DataFrame, entry: Mapping, warehouse: str | None, load_id: str | None, evolve: bool
) -> str | None:
    kind = entry["type"]
    if kind == "stdout_pretty":
        stdout_pretty(df)
        return None
    if kind == "parquet_dir":
        if load_id is None:
            return parquet_dir(df, entry["id"], entry["path"])
        target = f"{entry['path'].rstrip('/')}/{entry['id']}.parquet"
        df.write.mode("overwrite").parquet(f"{target}/batch_id={load_id}")
        return target
    if kind == "iceberg" and entry.get("catalog"):
        # A table format's own catalog keeps schema, snapshots and commits.
        name = _catalog_name(entry)
        append_to_catalog(df, name, load_id)
        return name
    if kind == "iceberg":
        table = LandedTable(df.sparkSession, _table_root(df.sparkSession, entry, warehouse), entry.get("partition_by", ()))
        table.append(df, load_id, evolve=entry.get("auto_schema_evolution", evolve))
        return table.root
    raise ValueError(f"unknown sink type {kind}")


def run_flow(
    spark: SparkSession,
    source: Mapping | str | Path,
    inputs: Mapping[str, DataFrame] | None = None,
    warehouse: str | None = None,
    checkpoint: str | None = None,
    reader: Reader = connector,
    every: str | None = None,
) -> dict:
    """Run a flow: tables once, topics as streams.

    Returns for each sink where it wrote, under ``queries`` the streaming queries started, and under
    ``finish`` a function that waits for them and then runs what is left in open windows: a step with
    a ``window_size`` runs once for so many micro-batches of a topic, and at the end for the rest. A
    table is one window.
    ``inputs`` may supply the frame of a source. For a stream every micro-batch goes through the
    whole flow from its source, so transforms may use anything a table allows, including row
    numbers within the batch; a topic that has a table of its own passes on the rows of each load.
    Topics need a ``checkpoint``, a folder that outlives the run. The SQL functions of :mod:`tidemill.functions.text` can be used in
    queries. ``every`` is the trigger interval; without it topics are drained.
    """
    flow = Flow(load_spec(source))
    register_functions(pin_settings(spark))
    given = dict(inputs or {})
    tables: dict[str, DataFrame] = {}
    streams: dict[str, DataFrame] = {}
    for name in flow.group("sources"):
        entry = flow.nodes[name]
        if name in given:
            (streams if given[name].isStreaming else tables)[name] = given[name]
        elif entry["type"] == "file_csv":
            declared = schema_from_config(entry["schema"]) if entry.get("schema") else None
            tables[name] = csv_scan(spark, entry["path"], entry.get("has_header", False), declared)
        elif entry["type"] == "kafka":
            streams[name] = kafka_stream(spark, entry, reader)
        else:
            raise ValueError(f"unknown source type {entry['type']}")

    if streams and checkpoint is None:
        raise ValueError("topics need a checkpoint folder: without it every run would read them anew")
    results: dict = {"queries": [], "finish": lambda: None}
    sinks = flow.group("sinks")
    if tables:
        built = flow.frames(tables, f"{checkpoint}/schemas" if checkpoint else None)
        for name in sinks:
            if name in built:
                results[name] = _write(built[name], flow.nodes[name], warehouse, None, flow.evolves)
    for name, stream in streams.items():
        place = f"{checkpoint}/{name}"
        entry = flow.nodes[name]
        mapping = entry.get("topic_mapping")
        onward = _onward(flow, name, warehouse, f"{checkpoint}/schemas", f"{place}/windows")
        if mapping:
            root = _table_root(spark, {"table_name": mapping["iceberg_table"], **mapping}, warehouse)
            loader = TopicTable(
                root,
                entry.get("schema"),
                mapping.get("sql_transform"),
                mapping.get("auto_schema_evolution", flow.evolves),
                tuple(mapping.get("partition_by") or ()),
                mapping.get("dead_letters"),
            )
            results[name] = root

            def run(batch: DataFrame, load_id: str, loader=loader, onward=onward) -> None:
                loader.load(batch, load_id, lambda rows: onward(rows, load_id))
        else:
            run = _batch_runner(flow, name, onward, f"{checkpoint}/schemas")
        results["queries"].append(each_batch(stream, run, place, name, every))
        for sink in flow.behind(name):
            target = flow.nodes[sink]
            if target.get("catalog"):
                results[sink] = _catalog_name(target)
            elif target["type"] == "parquet_dir":
                results[sink] = f"{target['path'].rstrip('/')}/{sink}.parquet"
            elif target["type"] == "iceberg":
                results[sink] = _table_root(spark, target, warehouse)
    if results["queries"]:
        started = dict(zip(streams, results["queries"]))
        results["finish"] = lambda: _finish(flow, spark, started, warehouse, checkpoint)
    return results


def _finish(flow: Flow, spark: SparkSession, started: Mapping, warehouse: str | None, checkpoint: str) -> None:
    """Wait for draining queries, and send what their open windows have through the rest of the flow."""
    for source, query in started.items():
        query.awaitTermination()
        for name in flow.group("transforms"):
            if flow.windows[name] != name:
                continue
            buffer = BatchBuffer(spark, f"{checkpoint}/{source}/windows/{name}", flow.size_of(name))
            if (rest := buffer.open_window()) is None:
                continue
            first, last, rows = rest
            built = flow.frames({name: _transform(flow.nodes[name], f"{checkpoint}/schemas")(rows)}, f"{checkpoint}/schemas")
            for sink in flow.behind(name):
                _write(built[sink], flow.nodes[sink], warehouse, _window_load(source, query.id, name, first, sink), flow.evolves)
            buffer.done(last)


def _window_load(source: str, query: str, step: str, first: int, sink: str) -> str:
    return f"{source}-{query}-{step}-{first:012d}-{sink}"


def _onward(flow: Flow, source: str, warehouse: str | None, registry: str, windows: str):
    """Send a source's typed rows through the flow; each sink's load has an id of its own: that of the
    batch, or of the window that the rows come from."""

    def run(rows: DataFrame, load_id: str) -> None:
        behind = flow.behind(source)
        if not behind:
            return
        number, first = int(load_id.rsplit("-", 1)[1]), {}
        buffers = {
            n: BatchBuffer(rows.sparkSession, f"{windows}/{n}", flow.size_of(n)) for n in flow.nodes if flow.windows[n] == n
        }

        def gather(name: str, arrived: DataFrame) -> DataFrame | None:
            full = buffers[name].add(arrived, number)
            if full is None:
                return None
            first[name] = full[0]
            return full[1]

        built = flow.frames({source: rows}, registry, gather)
        for sink in behind:
            if sink in built:
                step = flow.windows[sink]
                own = f"{load_id}-{sink}"
                if step is not None:
                    own = _window_load(source, query_id(rows), step, first[step], sink)
                _write(built[sink], flow.nodes[sink], warehouse, own, flow.evolves)
        for name in first:
            buffers[name].done(number)

    return run


def _batch_runner(flow: Flow, source: str, onward, registry: str):
    entry = flow.nodes[source]

    def run(batch: DataFrame, load_id: str) -> None:
        batch = batch.persist()
        try:
            is_text = batch.columns == ["value"]
            log = SchemaLog(batch.sparkSession, f"{registry}/{source}")
            rows = parse_messages(batch, entry.get("schema"), log) if is_text else batch
            if not rows.columns:
                return
            onward(rows, load_id)
        finally:
            batch.unpersist()

    return run
