"""One query per source, schema step, transform, sink and streaming operator.

Each runs over the whole of a given table. Where an operator needs files of some kind (CSV, JSON,
a topic's messages, a table that grew in two loads), Spark first writes them from a given table to
the shared folder, so the amount of work follows the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_data, passthrough
from ..operators.distinct import DistinctCounts
from ..operators.flatten import flatten_columns, json_flatten
from ..operators.joins import daily_price_and_news
from ..operators.partitioning import add_partition
from ..operators.quality import at_least_rules, check_rules, completeness, required_rules, validate
from ..operators.routing import tagged
from ..operators.sql import sql_transform
from ..operators.ticker import preferred_quote, unpivot_ticker
from ..schema import conform_and_union, infer_schema, nested_paths, schema_evolution, schema_from_config
from ..session import scratch_path, pin_settings
from ..sinks.files import kafka_frame, parquet_dir, partitioned_write
from ..sinks.changes import each_change
from ..sinks.landed import LandedTable, append_to_catalog
from ..sinks.variant_table import VariantTable
from ..sources.csv_files import csv_rejects, csv_scan
from ..sources.json_arrays import array_scan
from ..sources.json_files import json_scan
from ..sources.json_values import parse_json, split_json
from ..sources.kafka import kafka_stream
from ..sources.tables import parquet_scan, parquet_stream
from ..streaming.count_window import close_window, each_window
from ..streaming.late import late_log, part_late
from ..streaming.ingest import drain, each_batch, to_landed, to_parquet
from ..streaming.topic_table import TopicTable
from ..streaming.windows import joint_window_stats, latest_updates, to_updates, window_stats
from . import views
from .flow import run_flow
from .reports import rounded
from .views import table, with_views

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of an array that a query writes for a reader, about.
ARRAY_ROWS = 50_000

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: function(pin_settings(spark), folder)
        if sql:
            ORACLE[name] = with_views(sql)
        return function

    return add


def _bigint(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _event_json(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON messages with a nested object and an array."""
    events = table(spark, folder, "events")
    nested = F.struct(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("kind")).alias("detail")).alias("meta"),
        F.array(F.col("event_type"), F.lit("x")).alias("tags"),
        F.col("value"),
        (F.col("event_type") == "purchase").alias("paid"),
    )
    return events.select(F.to_json(nested).alias("value"))


def _topic_files(spark: SparkSession, folder: str) -> str:
    """Events as flat JSON messages, one per line, in the shared folder."""
    path = scratch_path(spark, "topic")
    events = table(spark, folder, "events")
    message = F.to_json(F.struct("event_id", F.col("ts").alias("timestamp"), "user_id", "event_type", "value"))
    events.select(message.alias("value")).write.text(path)
    return path


def _text_reader(path: str):
    return lambda spark, options: spark.readStream.text(path)


_MESSAGE = {
    "auto_infer": False,
    "fields": [
        {"name": "event_id", "data_type": "int64"},
        {"name": "timestamp", "data_type": "string"},
        {"name": "user_id", "data_type": "int64"},
        {"name": "event_type", "data_type": "string"},
        {"name": "value", "data_type": "float64"},
    ],
}


# Sources


@query("src1_csv_scan", """
    select c_custkey as col_0, c_name as col_1, c_nationkey + case when c_custkey > 120 then 0.5 else 0 end::double as col_2,
           c_acctbal as col_3, case when c_custkey > 130 then c_mktsegment else c_custkey::varchar end as col_4 from customer""")
def _csv(spark, folder):
    """Several files; two columns look like whole numbers in their first 100 rows."""
    path = scratch_path(spark, "csv")
    customer = table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_custkey") > 120, (F.col("c_nationkey") + 0.5).cast("string"))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("c_nation"),
        "c_acctbal",
        F.when(F.col("c_custkey") > 130, F.col("c_mktsegment")).otherwise(F.col("c_custkey").cast("string")).alias("c_text"),
    )
    customer.repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey").write.csv(path)
    return csv_scan(spark, f"{path}/*.csv")


@query("src1_csv_rejects", """
    select c_custkey as col_0, case when c_custkey % 10 = 0 then 'col_1 is no bigint' end as reason from customer
    where c_custkey % 10 = 0""")
def _csv_rejects(spark, folder):
    """Rows that do not fit a given schema, with the reason."""
    path = scratch_path(spark, "csv-rejects")
    nation = F.when(F.col("c_custkey") % 10 == 0, F.col("c_mktsegment")).otherwise(F.col("c_nationkey").cast("string"))
    table(spark, folder, "customer").select("c_custkey", nation.alias("n")).write.csv(path)
    declared = T.DataType.fromDDL("col_0 bigint, col_1 bigint")
    rejected = csv_rejects(spark, f"{path}/*.csv", schema=declared)
    return rejected.select(F.col("col_0").cast("bigint").alias("col_0"), "reason")


@query("src2_topic_stream", "select event_id, user_id, event_type, value from events")
def _topic(spark, folder):
    stream = kafka_stream(
        spark, {"brokers": "unused:9092", "topic": "events"}, _text_reader(_topic_files(spark, folder))
    )
    rows = parse_json(stream, schema_from_config(_MESSAGE)).drop("timestamp")
    target, checkpoint = scratch_path(spark, "topic-rows"), scratch_path(spark, "topic-checkpoint")
    drain(to_parquet(rows, target, checkpoint))
    return spark.read.parquet(target)


@query("src3_json_rows", """
    select event_id, case when event_id % 2 = 0 then event_id else 0 end as k,
           case when event_id % 3 = 0 then value else 0 end as score, case event_id % 4 when 0 then event_type else '' end as label,
           (event_id % 5 = 0 and value > 20) as seen from events""")
def _json_rows(spark, folder):
    """Every field is there, missing, null or of another type in some of the messages."""
    declared = T.DataType.fromDDL("k bigint, score double, label string, seen boolean")
    every = lambda n, there, other=None: F.when(F.col("event_id") % n == 0, there).otherwise(F.lit(other))
    fields = {
        "k": every(2, F.to_json(F.struct(F.col("event_id").alias("k")))),
        "score": every(3, F.to_json(F.struct(F.col("value").alias("score"))), '{"score":"none"}'),
        "label": every(4, F.to_json(F.struct(F.col("event_type").alias("label"))), '{"label":null}'),
        "seen": every(5, F.to_json(F.struct((F.col("value") > 20).alias("seen")))),
    }
    inner = F.concat_ws(",", *[F.regexp_extract(x, r"^\{(.*)\}$", 1) for x in fields.values()])
    messages = table(spark, folder, "events").select("event_id", F.concat(F.lit("{"), inner, F.lit("}")).alias("message"))
    return parse_json(messages, declared, "message", ["event_id"], on_missing="default")


@query("src4_json_scan", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def _json_files(spark, folder):
    path = scratch_path(spark, "json")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").json(path)
    return json_scan(spark, path)


@query("src4_json_layouts", """
    select layout, o_orderkey, o_custkey from (select o_orderkey, o_custkey,
    case when o_orderkey % 500 = 0 then 'object' when o_orderkey % 2 = 0 then 'array' else 'lines' end as layout from orders)""")
def _json_layouts(spark, folder):
    """One folder with files of one object, files of an array of some hundreds, and files of lines."""
    path = scratch_path(spark, "json-layouts")
    layout = F.when(F.col("o_orderkey") % 500 == 0, "object").when(F.col("o_orderkey") % 2 == 0, "array").otherwise("lines")
    orders = table(spark, folder, "orders").select(layout.alias("layout"), "o_orderkey", "o_custkey")
    whole = F.to_json(F.struct("layout", "o_orderkey", "o_custkey"))
    pretty = F.concat(F.lit("{\n"), F.substr(whole, F.lit(2)))
    orders.filter("layout = 'lines'").select(whole.alias("value")).repartition(3).write.text(f"{path}/lines")
    # Each file is a record: tasks follow their number, 250 files each.
    writers = orders.count() // (250 * 500) + 4
    objects = orders.filter("layout = 'object'").select(pretty.alias("value"))
    objects.repartition(writers).write.option("maxRecordsPerFile", 1).text(f"{path}/objects")
    arrays = orders.filter("layout = 'array'").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("part")).agg(F.collect_list(whole).alias("rows"))
    listed = F.concat(F.lit("[\n"), F.array_join("rows", ",\n"), F.lit("\n]"))
    arrays.select(listed.alias("value")).repartition(writers).write.option("maxRecordsPerFile", 1).text(f"{path}/arrays")
    return json_scan(spark, path, pattern="*.txt")


@query("src4_split_array", r"""
    select o_orderkey, o_orderstatus, concat('}{"', o_orderpriority, '\\"]}') as o_comment, o_totalprice as price from orders""")
def _split_array(spark, folder):
    """Files of one array each, with braces and quotes in their texts, read in ranges of 64 KB.

    A file's rows meet in the task that writes it, so the files, not their sizes, grow with the table.
    """
    path = scratch_path(spark, "json-arrays")
    note = F.concat(F.lit('}{"'), F.col("o_orderpriority"), F.lit('\\\\"]}'))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", note.alias("o_comment"), F.struct(F.col("o_totalprice").alias("price")).alias("o"))
    in_file = Window.partitionBy("file").orderBy("o_orderkey")
    files = max(3, -(-orders.count() // ARRAY_ROWS))
    lines = orders.withColumn("file", F.pmod(F.xxhash64("o_orderkey"), F.lit(files))).withColumns(
        {"first": F.lag("o_orderkey").over(in_file).isNull(), "last": F.lead("o_orderkey").over(in_file).isNull()}
    )
    text = F.concat(
        F.when(F.col("first"), "[").otherwise(","), F.to_json(F.struct("o_orderkey", "o_orderstatus", "o_comment", "o")),
        F.when(F.col("last"), "]").otherwise(""),
    )
    lines.select(text.alias("value"), "file").write.partitionBy("file").text(path)
    rows = array_scan(spark, path, "*.txt", range_bytes=64 << 10)
    return rows.select("o_orderkey", "o_orderstatus", "o_comment", F.col("o.price").alias("price"))


@query("src5_parquet_glob", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def _parquet_glob(spark, folder):
    path = scratch_path(spark, "parquet")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    partitioned_write(orders, path, ["o_orderstatus"])
    return parquet_scan(spark, f"{path}/**/*.parquet")


@query("src6_landed_scan", "select c_custkey, c_name, c_mktsegment from customer")
def _landed(spark, folder):
    landed = LandedTable(spark, scratch_path(spark, "landed"), ["c_mktsegment"])
    landed.append(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    return landed.read()


@query("src6_change_feed", "select o_orderkey, o_orderstatus from orders")
def _change_feed(spark, folder):
    """A consumer that copies what is new: a load sent again and one that is not logged add nothing."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    source, copy = (LandedTable(spark, scratch_path(spark, f"feed-{k}")) for k in ("source", "copy"))
    orders.limit(5).write.parquet(f"{source.root}/data/load_id=lost/schema_id=1")
    for status in ("O", "F", "O", "P"):
        source.append(orders.where(F.col("o_orderstatus") == status), status)
        each_change(source, "copier", copy.append)
    return copy.read()


@query("src7_dead_letters", """
    select event_id, case when event_type = 'error' then 'malformed' when event_type = 'view' then 'not an object'
           else 'good' end as outcome from events""")
def _dead_letters(spark, folder):
    """Error events carry a message that is cut short, views one that is a bare list."""
    message = F.col("props")
    sent = (
        F.when(F.col("event_type") == "error", F.left(message, F.length(message) - 1))
        .when(F.col("event_type") == "view", F.concat(F.lit("["), message, F.lit("]")))
        .otherwise(message)
    )
    messages = table(spark, folder, "events").select("event_id", sent.alias("value"))
    good, bad = split_json(messages)
    return good.select("event_id", F.lit("good").alias("outcome")).unionByName(
        bad.select("event_id", F.col("reason").alias("outcome"))
    )


# Schemas


@query("sch1_configured_schema", """
    select event_id, case when event_id % 3 <> 1 then event_id end as k, case when event_id % 3 <> 2 then event_type end as label,
           case event_id % 3 when 1 then 'k required' when 2 then 'label required' else '' end as broken from events""")
def _configured(spark, folder):
    """Messages that lack the one or the other field."""
    schema = schema_from_config(
        {"fields": [{"name": "k", "data_type": "int64", "nullable": False}, {"name": "label", "data_type": "text", "nullable": False}]}
    )
    message = F.to_json(F.struct(
        F.when(F.col("event_id") % 3 != 1, F.col("event_id")).alias("k"), F.when(F.col("event_id") % 3 != 2, F.col("event_type")).alias("label")
    ))
    rows = parse_json(table(spark, folder, "events").withColumn("message", message), schema, "message", ["event_id"])
    checked = check_rules(rows, required_rules(schema))
    return checked.select("event_id", "k", "label", F.array_join("failed_rules", ",").alias("broken"))


@query("sch2_merge_promote", """
    select cast(c_custkey as double) as k, cast(c_nationkey as bigint) as nation, c_mktsegment as label, null as name
    from customer
    union all select cast(s_suppkey as double) + 0.5, s_nationkey, null, s_name from supplier""")
def _merged(spark, folder):
    first = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label")
    )
    second = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + F.lit(0.5)).alias("k"),
        F.col("s_nationkey").cast("bigint").alias("nation"),
        F.lit(None).cast("int").alias("label"),
        F.col("s_name").alias("name"),
    )
    return conform_and_union([first, second])[0]


def _schema_rows(messages: DataFrame, paths: list[tuple[str, T.DataType]]) -> DataFrame:
    """The inferred schema as rows, with the number of messages it was found in."""
    fields = F.array(
        *[F.struct(F.lit(p).alias("field"), F.lit(t.simpleString()).alias("field_type")) for p, t in paths]
    )
    return messages.agg(F.count(F.lit(1)).alias("messages")).select(F.inline(fields), "messages")


@query("sch3_inferred_schema", """
    select field, field_type, messages from (select count(*) as messages from events),
    (values ('id', 'bigint'), ('meta', 'string'), ('paid', 'boolean'), ('tags', 'array<string>'), ('value', 'double'))
    as t(field, field_type)""")
def _inferred(spark, folder):
    messages = _event_json(spark, folder)
    return _schema_rows(messages, [(f.name, f.dataType) for f in infer_schema(messages).fields])


@query("sch3_variant_landing", """
    select event_id as id, event_type as kind, case when event_id % 3 = 2 then value end as extra,
           case when event_id % 3 = 2 then concat('{"user":', user_id, '}') end as who from events""")
def _variant_landing(spark, folder):
    """Three loads without a schema; two fields first appear in the third, one of them an object."""
    landed = VariantTable(spark, scratch_path(spark, "variants"))
    events = table(spark, folder, "events")
    fields = [F.col("event_id").alias("id"), F.col("event_type").alias("kind")]
    more = [F.col("value").alias("extra"), F.struct(F.col("user_id").alias("user")).alias("who")]
    for k in range(3):
        message = F.to_json(F.struct(*fields, *(more if k == 2 else [])))
        landed.load(events.where(F.col("event_id") % 3 == k).select(message.alias("value")), f"load-{k}")
    return landed.typed()


@query("sch4_nested_paths", """
    select field, field_type, messages from (select count(*) as messages from events),
    (values ('id', 'bigint'), ('meta.user', 'bigint'), ('meta.detail.kind', 'string'), ('paid', 'boolean'),
            ('tags', 'string'), ('value', 'double')) as t(field, field_type)""")
def _paths(spark, folder):
    messages = _event_json(spark, folder)
    return _schema_rows(messages, nested_paths(infer_schema(messages, keep_objects=True)))


@query("sch5_schema_evolution", """
    select event_id, cast(user_id as double) as user_id, null::varchar as channel, event_type, value from events""")
def _evolution(spark, folder):
    registered = T.DataType.fromDDL("event_id bigint, user_id double, channel string")
    arrived = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return schema_evolution(arrived, registered, auto_infer=True)


@query("sch6_table_evolution", """
    select cast(c_custkey as double) as k, cast(c_nationkey as bigint) as nation, null as name from customer
    union all select cast(s_suppkey as double) + 0.5, s_nationkey, s_name from supplier""")
def _table_evolution(spark, folder):
    landed = LandedTable(spark, scratch_path(spark, "evolving"))
    landed.append(
        table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation")),
        "first",
        evolve=True,
    )
    landed.append(
        table(spark, folder, "supplier").select(
            (F.col("s_suppkey") + F.lit(0.5)).alias("k"),
            F.col("s_nationkey").cast("bigint").alias("nation"),
            F.col("s_name").alias("name"),
        ),
        "second",
        evolve=True,
    )
    return landed.read()


# Transforms


@query("trf1_passthrough", "select * from supplier")
def _passthrough(spark, folder):
    return passthrough(table(spark, folder, "supplier"))


@query("trf2_clean_title", """
    select doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '[\\s]+'), lambda w: w <> ''),
           lambda w: concat(case w[1] when 'ß' then 'SS' else upper(w[1]) end, w[2:])), ' ') as text,
           concat(upper(lang[1]), lang[2:]) as lang from documents""")
def _clean(spark, folder):
    padded = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit(" \t "), "text", F.lit(" \n")).alias("text"), "lang"
    )
    return clean_data(padded, remove_nulls=True, trim_strings=True, normalize_case="title")


@query("trf3_flatten_columns", """
    select event_id as id, user_id as meta_user, event_type as meta_detail_kind, event_type as tags, value from events""")
def _flat_columns(spark, folder):
    nested = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("kind")).alias("detail")).alias("meta"),
        F.array(F.col("event_type"), F.lit("x")).alias("tags"),
        "value",
    )
    return flatten_columns(nested)


@query("trf3_flatten_text", """
    select event_id, concat('{"empty":[],"id":', event_id, ',"meta.detail.kind":"', event_type, '","meta.user":', user_id,
           ',"none":null,"tags":"', event_type, '"}') as flattened_data from events""")
def _flat_text(spark, folder):
    nested = F.struct(
        F.array().cast("array<string>").alias("empty"),
        F.col("event_id").alias("id"),
        F.struct(F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("kind")).alias("detail")).alias("meta"),
        F.lit(None).cast("string").alias("none"),
        F.array(F.col("event_type"), F.lit("x")).alias("tags"),
    )
    text = F.to_json(nested, {"ignoreNullFields": "false"})
    messages = table(spark, folder, "events").select("event_id", text.alias("value"))
    return json_flatten(messages, ".", 5, value="value", by_shape=True)


@query("trf4_partition_key", """
    select event_id, concat(event_type, '-', user_id, '-unknown') as partition_key, '2024-01-31' as partition_date,
           concat(event_type, '/', user_id) as joined, strftime(ts, '%Y/%m/%d') as dated
    from events""")
def _partition_key(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id", "ts")
    day = F.lit(views.AS_OF).cast("timestamp_ntz")
    joined = add_partition(events, ["event_type", "user_id"]).withColumnRenamed("partition_key", "joined")
    dated = add_partition(joined.drop("partition_date"), ["ts"], "yyyy/MM/dd").withColumnRenamed("partition_key", "dated")
    keyed = add_partition(dated.drop("partition_date"), ["event_type", "user_id", "region"], "{0}-{1}-{2}", day)
    return keyed.drop("event_type", "user_id", "ts")


@query("trf5_sql_transform", """
    select l_returnflag, l_linestatus, count(*) as orders, round(avg(l_quantity) + 1e-7, 4) as avg_quantity,
           round(sum(l_extendedprice * (1 - l_discount)), 0) as revenue
    from lineitem where l_shipdate < timestamp '2001-01-01 00:00:00' group by l_returnflag, l_linestatus""")
def _sql(spark, folder):
    return sql_transform(
        table(spark, folder, "lineitem"),
        "SELECT l_returnflag, l_linestatus, COUNT(*) AS orders, ROUND(AVG(l_quantity) + 1e-7, 4) AS avg_quantity, "
        "ROUND(SUM(l_extendedprice * (1 - l_discount)), 0) AS revenue FROM input_data "
        "WHERE l_shipdate < TIMESTAMP_NTZ '2001-01-01 00:00:00' GROUP BY l_returnflag, l_linestatus",
    )


@query("trf6_count_window", """
    select event_type, count(*) as events, cast(3 as bigint) as windows from events group by event_type""")
def _count_window(spark, folder):
    """Two files per evaluation: each window of files is counted by SQL, and the counts add up."""
    files = scratch_path(spark, "windows")
    table(spark, folder, "events").select("event_type", "value").repartition(6).write.parquet(files)
    out, checkpoint = scratch_path(spark, "window-counts"), scratch_path(spark, "window-checkpoint")

    def evaluate(batch: DataFrame, load_id: str) -> None:
        counts = sql_transform(batch, "SELECT event_type, COUNT(*) AS events FROM input_data GROUP BY event_type")
        counts.write.mode("overwrite").parquet(f"{out}/load_id={load_id}")

    drain(each_batch(parquet_stream(spark, files, 2), evaluate, checkpoint, "windows"))
    counts = spark.read.parquet(out)
    return counts.groupBy("event_type").agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("windows"))


_ROUTES = {"user": "event_type IN ('signup', 'view', 'click', 'purchase')", "system": "event_type = 'error'"}


@query("trf6_batch_windows", """
    select min(event_id % 7) as first_batch, max(event_id % 7) as last_batch, count(*) as events, count(distinct user_id) as users
    from events group by (event_id % 7) // 3""")
def _batch_windows(spark, folder):
    """Seven batches, each by a run of its own, in windows of three: SQL sees each window as one table, the
    last one, of a single batch, when the stream has ended."""
    files, checkpoint = scratch_path(spark, "window-batches"), scratch_path(spark, "window-checkpoint")
    events = table(spark, folder, "events").select("event_id", "user_id", (F.col("event_id") % 7).alias("batch"))
    out = LandedTable(spark, scratch_path(spark, "window-counts"))
    counting = (
        "SELECT min(batch) AS first_batch, max(batch) AS last_batch, count(*) AS events, "
        "count(DISTINCT user_id) AS users FROM input_data"
    )

    def write(rows, load):
        LandedTable(rows.sparkSession, out.root).append(sql_transform(rows, counting), load)

    for batch in range(7):
        events.where(F.col("batch") == batch).write.mode("append").parquet(files)
        query = drain(each_window(parquet_stream(spark, files), write, checkpoint, "counted", 3))
    close_window(query, spark, write, checkpoint, "counted", 3)
    return out.read()


@query("g4_split_events", """
    select case event_type when 'error' then 'system' else 'user' end as branch, event_id, event_type from events""")
def _split(spark, folder):
    return tagged(_ROUTES)(table(spark, folder, "events").select("event_id", "event_type"))


_QUOTED = {"USD": 1.0, "EUR": 0.9, "GBP": 0.8, "SEK": 10.5}
_RATES = f"(values {', '.join(map(str, _QUOTED.items()))}) as r(currency, rate)"


def _ticker(spark: SparkSession, folder: str) -> DataFrame:
    """A payload per event: quotes in four currencies; clicks come without dollars, errors empty."""

    def quote(name: str):
        last = F.col("value") * F.lit(_QUOTED[name])
        fields = {"15m": last + 1, "buy": last - 1, "last": last, "sell": last, "symbol": F.lit("#")}
        return F.struct(*[column.alias(field) for field, column in fields.items()]).alias(name)

    full = F.to_json(F.struct(*[quote(name) for name in _QUOTED]))
    short = F.to_json(F.struct(quote("EUR"), quote("SEK")))
    payload = F.when(F.col("event_type") == "error", "{}").when(F.col("event_type") == "click", short).otherwise(full)
    return table(spark, folder, "events").select("event_id", payload.alias("value"), F.col("ts").alias("timestamp"))


@query("trf11_ticker_unpivot", f"""
    select event_id, currency, value * rate as price, value * rate - 1 as buy_price, value * rate as sell_price,
           value * rate + 1 as price_15m, ts as timestamp
    from events, (select currency, cast(rate as double) as rate from {_RATES})
    where currency in ('USD', 'EUR') and event_type <> 'error' and (event_type <> 'click' or currency = 'EUR')""")
def _unpivot(spark, folder):
    return unpivot_ticker(_ticker(spark, folder), currencies=" usd, EUR ,chf")


@query("trf12_preferred_quote", """
    select event_id, timestamp, currency, price, price - 1 as buy_price, price as sell_price,
           round(case when price > 0 then (price + 1 - price) / price * 100 else 0 end, 4) as price_change
    from (select event_id, ts as timestamp, case event_type when 'click' then 'EUR' else 'USD' end as currency,
                 value * cast(case event_type when 'click' then 0.9 else 1 end as double) as price
          from events where event_type <> 'error')""")
def _preferred(spark, folder):
    chosen = preferred_quote(_ticker(spark, folder))
    return chosen.withColumn("price_change", F.round("price_change", 4))


@query("jon1_daily_join", """
    select cast(m.timestamp as date) as date, round(avg(m.price) + 1e-7, 4) as avg_price,
           round(avg(m.price_change_24h) + 1e-7, 4) as avg_price_change, count(n.id) as news_count,
           round(avg(n.sentiment_score) + 1e-7, 4) as avg_sentiment
    from v_market m left join v_news n on cast(m.timestamp as date) = cast(n.published_at as date) and n.source <> 'src1'
    group by 1""")
def _daily(spark, folder):
    news = views.news(spark, folder).filter(F.col("source") != "src1")
    return rounded(daily_price_and_news(views.market(spark, folder), news))


@query("fn_expressions", """
    select event_id, 7 // 2 as whole, cast(7 as double) / 2 as fraction, case when user_id = 0 then null
           else value / user_id end as per_user, value between 10 and 20 as middling,
           event_type in ('click', 'view') as browsing, (event_type = 'purchase') = true as paid,
           replace(replace(props, '{', ''), '}', '') as bare, cast(length(props) as bigint) as props_length,
           cast(len(string_split(props, ':')) as bigint) as parts, cast(ts as date) as day,
           cast(extract(year from ts) as bigint) as year, cast(extract(month from ts) as bigint) as month,
           cast(extract(day from ts) as bigint) as day_of_month, cast(extract(hour from ts) as bigint) as hour,
           ts >= timestamp '2024-01-31 00:00:00' - interval 7 day as last_week,
           ts >= timestamp '2024-01-31 00:00:00' - interval 24 hour as last_day, -value as negated, 'events' as source,
           try_cast(event_type as integer) as no_number
    from events""")
def _expressions(spark, folder):
    """The scalar functions in use, as SQL text. Names are written in upper case on purpose."""
    return sql_transform(
        table(spark, folder, "events"),
        """
        SELECT EVENT_ID AS event_id, 7 DIV 2 AS whole, 7 / 2 AS fraction,
               TRY_DIVIDE(VALUE, USER_ID) AS per_user, VALUE BETWEEN 10 AND 20 AS middling,
               EVENT_TYPE IN ('click', 'view') AS browsing, (EVENT_TYPE = 'purchase') = TRUE AS paid,
               REGEXP_REPLACE(PROPS, '[{}]', '') AS bare, CAST(LENGTH(PROPS) AS BIGINT) AS props_length,
               CAST(ARRAY_SIZE(SPLIT(PROPS, ':')) AS BIGINT) AS parts, DATE(TS) AS day,
               CAST(EXTRACT(YEAR FROM TS) AS BIGINT) AS year, CAST(EXTRACT(MONTH FROM TS) AS BIGINT) AS month,
               CAST(EXTRACT(DAY FROM TS) AS BIGINT) AS day_of_month, CAST(HOUR(TS) AS BIGINT) AS hour,
               TS >= TIMESTAMP_NTZ '2024-01-31 00:00:00' - INTERVAL 7 DAY AS last_week,
               TS >= TIMESTAMP_NTZ '2024-01-31 00:00:00' - INTERVAL '24' HOUR AS last_day, -VALUE AS negated,
               'events' AS source, TRY_CAST(EVENT_TYPE AS INT) AS no_number
        FROM INPUT_DATA""",
    )


# Quality


_COUNTED = ("o_custkey", "o_orderpriority", "o_orderdate")


@query("agg3_distinct_bitmaps", " union all ".join(
    f"select {load} as load_id, '{c}' as name, count(distinct {c}) as distinct_values from orders {group}"
    for c in _COUNTED for load, group in (("o_orderstatus", "group by o_orderstatus"), ("'all'", ""))))
def _distinct(spark, folder):
    orders = table(spark, folder, "orders")
    counts = DistinctCounts(spark, scratch_path(spark, "distinct"), _COUNTED)
    for status in ("F", "O", "P", "F"):  # a load that is added again replaces itself
        counts.add(orders.filter(F.col("o_orderstatus") == status), status)
    return counts.counts_by_load().unionByName(counts.counts().withColumn("load_id", F.lit("all")))


@query("qlt1_completeness", " union all ".join(
    f"select '{c}' as column_name, count(*) as total_records, count({c}) as non_null_records, "
    f"cast(cast(count({c}) * 100.0 / count(*) as decimal(5, 2)) as double) as completeness_pct from v_flights"
    for c in ("fl_date", "dep_delay", "arr_delay", "distance", "air_time", "order_key", "line_number")))
def _complete(spark, folder):
    shares = completeness(views.flights(spark, folder))
    return shares.withColumn("completeness_pct", F.col("completeness_pct").cast("double"))


@query("qlt2_rejected_rows", """
    select order_key, line_number, fl_date, distance, air_time, dep_delay, arr_delay,
           concat_ws(',', case when arr_delay < 0 then 'arr_delay below 0' end,
                     case when dep_delay is null then 'dep_delay required' end) as failed_rules
    from v_flights where arr_delay < 0 or dep_delay is null""")
def _rejected(spark, folder):
    rules = {**at_least_rules(["arr_delay"]), "dep_delay required": F.col("dep_delay").isNotNull()}
    _, rejected = validate(views.flights(spark, folder), rules)
    return rejected.withColumn("failed_rules", F.array_join("failed_rules", ","))


# Sinks


@query("snk2_parquet_dir", "select * from part")
def _parquet_dir(spark, folder):
    parts = table(spark, folder, "part")
    return spark.read.parquet(parquet_dir(parts, "parts", scratch_path(spark, "parquet-dir")))


def _two_loads(spark: SparkSession, folder: str) -> LandedTable:
    orders = table(spark, folder, "orders")
    landed = LandedTable(spark, scratch_path(spark, "loads"), ["o_orderstatus"])
    open_ = F.col("o_orderstatus") == "O"
    landed.append(orders.filter(open_), "1-open")
    landed.append(orders.filter(open_), "1-open")
    landed.append(orders.filter(~open_), "2-other")
    return landed


@query("snk3_append", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def _append(spark, folder):
    """Two loads, the first of them sent twice: it must count once."""
    return _two_loads(spark, folder).read()


@query("snk3_two_streams", "select event_id, value, ts from events")
def _two_streams(spark, folder):
    """Two streams of one name, with a checkpoint each, into one table: no load replaces another."""
    landed = LandedTable(spark, scratch_path(spark, "two-streams"))
    for half in (0, 1):
        files = scratch_path(spark, f"half-{half}")
        events = table(spark, folder, "events").select("event_id", "value", "ts")
        events.filter(F.col("event_id") % 2 == half).repartition(2).write.parquet(files)
        drain(to_landed(parquet_stream(spark, files, 1), landed.root, scratch_path(spark, "half-checkpoint"), "halves"))
    return landed.read()


@query("snk3_retyped_values", """
    select o_orderkey, case when o_orderkey % 5 = 0 then null else o_custkey end as o_custkey,
           case when o_orderkey % 5 = 0 then concat('c-', o_custkey) end as unfit_value,
           count(*) filter (where o_orderkey % 5 = 0) over () as unfit_values from orders""")
def _retyped(spark, folder):
    """A load whose customer numbers are text, some of them no numbers: their text is kept."""
    landed = LandedTable(spark, scratch_path(spark, "retyped"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    landed.append(orders.filter("o_orderkey % 5 > 2"))
    text = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "c-").otherwise(""), F.col("o_custkey").cast("string"))
    landed.append(orders.filter("o_orderkey % 5 <= 2").withColumn("o_custkey", text), evolve=True)
    unfit = landed.unfit().select(
        F.get_json_object("row", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.col("value").alias("unfit_value")
    )
    logged = landed.loads().agg(F.sum("unfit_values").alias("unfit_values"))
    return landed.read().join(unfit, "o_orderkey", "left").join(F.broadcast(logged))


@query("snk4_load_audit", """
    select cast(1 as bigint) as snapshot_id, null::bigint as parent_id, 'append' as operation,
           count(*) filter (where o_orderstatus = 'O') as added_records,
           count(*) filter (where o_orderstatus = 'O') as total_records from orders
    union all select 2, 1, 'append', count(*) filter (where o_orderstatus <> 'O'), count(*) from orders""")
def _audit(spark, folder):
    loads = _two_loads(spark, folder).loads()
    return loads.select(*_bigint("snapshot_id", "parent_id"), "operation", "added_records", "total_records")


@query("snk4_time_ranges", """
    select o_orderstatus as load_id, min(o_orderdate)::timestamp as min_time, max(o_orderdate)::timestamp as max_time,
           count(*) as added_records, count(*) filter (where o_orderdate >= date '1996-01-01' and o_orderdate < date '1996-07-01') as in_range
    from orders group by all""")
def _time_ranges(spark, folder):
    """Loads with their first and last time, and rows read by time, for which loads outside are not opened."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    landed = LandedTable(spark, scratch_path(spark, "timed"), event_time="o_orderdate")
    for status in ("O", "F", "P"):
        landed.append(orders.where(F.col("o_orderstatus") == status), status)
    part = landed.read(since="1996-01-01", until="1996-07-01").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("in_range"))
    log = landed.loads().select("load_id", "min_time", "max_time", "added_records")
    return log.join(part.withColumnRenamed("o_orderstatus", "load_id"), "load_id", "left").withColumn(
        "in_range", F.coalesce("in_range", F.lit(0).cast("bigint"))
    )


@query("snk6_catalog_replay", "select o_orderkey, o_orderstatus as load_id from orders where o_orderstatus <> 'P'")
def _catalog_replay(spark, folder):
    """Loads into a table of the session's catalog, the first of them sent again: it is there once."""
    place = scratch_path(spark, "catalog")
    name = f"replayed_{place[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("O", "F", "O"):
        append_to_catalog(orders.where(F.col("o_orderstatus") == status).select("o_orderkey"), f"{name}.orders", status)
    return spark.table(f"{name}.orders")


@query("snk5_kafka_records", """
    select o_orderstatus as key, concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus,
           '","o_orderpriority":"', o_orderpriority, '","note":null}') as value from orders""")
def _records(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.lit(None).cast("string").alias("note")
    )
    return kafka_frame(rows, F.col("o_orderstatus"))


@query("snk7_partitioned_write", """
    select year(ts) as year, month(ts) as month, day(ts) as day, count(*) as events, round(sum(value), 2) as total
    from events group by all""")
def _partitioned(spark, folder):
    """Folders by year, month and day, all read again by their folders' names."""
    path = scratch_path(spark, "partitioned")
    events = table(spark, folder, "events").withColumns(
        {"year": F.year("ts"), "month": F.month("ts"), "day": F.day("ts")}
    )
    partitioned_write(events, path, ["year", "month", "day"])
    return (
        spark.read.parquet(path)
        .groupBy(*_bigint("year", "month", "day"))
        .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))
    )


@query("g3_topic_partitions", """
    select event_id, user_id, event_type, value, cast(ts as date) as partition_date, cast(hour(ts) as bigint) as hour
    from events where value > 10""")
def _topic_table(spark, folder):
    """Messages to a partitioned table: inferred schema, SQL per batch, evolution on."""
    stream = kafka_stream(
        spark, {"brokers": "unused:9092", "topic": "events"}, _text_reader(_topic_files(spark, folder))
    )
    loader = TopicTable(
        scratch_path(spark, "topic-table"),
        sql="SELECT event_id, user_id, event_type, value, DATE(timestamp) AS partition_date, "
        "HOUR(CAST(timestamp AS TIMESTAMP)) AS hour FROM input_data WHERE value > 10",
        evolve=True,
        partition_by=("partition_date", "hour"),
    )
    drain(loader.start(stream, scratch_path(spark, "topic-table-checkpoint"), "events"))
    rows = LandedTable(spark, loader.root).read()
    return rows.withColumn("hour", F.col("hour").cast("bigint"))


# Streams


@query("str1_continuous_ingest", "select event_id, ts, user_id, event_type, value from events")
def _ingest(spark, folder):
    """A stream over files, drained into a file sink."""
    stream = parquet_stream(spark, f"{folder.rstrip('/')}/events.parquet*").drop("props")
    target, checkpoint = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-checkpoint")
    drain(to_parquet(stream, target, checkpoint))
    return spark.read.parquet(target)


@query("str4_hourly_windows", """
    select date_trunc('hour', ts) as window_start, event_type, count(*) as data_points,
           round(avg(value) + 1e-7, 4) as avg_value, min(value) as min_value, max(value) as max_value
    from events group by all""")
def _windows(spark, folder):
    """Hourly windows per type over a stream of several files, with a watermark. The table spans
    a month and its files are in no order of time, so the watermark trails by a year. Means of a
    few values often end in a 5 at the digit rounded away: a nudge keeps both sides from differing."""
    files = scratch_path(spark, "window-events")
    table(spark, folder, "events").select("ts", "event_type", "value").repartition(4).write.parquet(files)
    stream = parquet_stream(spark, files, 2)
    hourly = window_stats(stream, "ts", "value", "1 hour", ["event_type"], late_by="365 days")
    out, checkpoint = scratch_path(spark, "hourly"), scratch_path(spark, "hourly-checkpoint")
    drain(to_updates(hourly, out, checkpoint))
    final = latest_updates(spark.read.parquet(out), ["window_start", "event_type"])
    return final.withColumns(
        {"window_start": F.col("window_start").cast("timestamp_ntz"), "avg_value": F.round(F.col("avg_value") + 1e-7, 4)}
    )


@query("str3_joint_watermark", """
    with newest as (
        select least(max(ts) filter (event_type <> 'click'), max(ts) filter (event_type = 'click' and ts < timestamp '2024-01-20'))
               - interval 1 hour as closed from events)
    select if(event_type = 'click', 'clicks', 'others') as source, date_trunc('hour', ts) as window_start, count(*) as data_points
    from events, newest where (event_type <> 'click' or ts < timestamp '2024-01-20') and date_trunc('hour', ts) + interval 1 hour <= closed
    group by all""")
def _joint(spark, folder):
    """Two sources as one stream; clicks end earlier, and windows close only as far as they have come."""
    events = table(spark, folder, "events").select("ts", "event_type", "value")
    click = F.col("event_type") == "click"
    streams = {}
    for name, rows in {"clicks": events.where(click & (F.col("ts") < "2024-01-20")), "others": events.where(~click)}.items():
        path = scratch_path(spark, f"joint-{name}")
        rows.write.parquet(path)
        streams[name] = parquet_stream(spark, path)
    closed = joint_window_stats(streams, "ts", "value", "1 hour", "1 hour")
    out, checkpoint = scratch_path(spark, "joint"), scratch_path(spark, "joint-checkpoint")
    drain(to_parquet(closed, out, checkpoint))
    window = F.col("window_start").cast("timestamp_ntz").alias("window_start")
    return spark.read.schema(closed.schema).parquet(out).select("source", window, "data_points")


@query("str5_late_rows", """
    select date_trunc('hour', ts) as window_start, count(*) as data_points from events group by all
    union all select timestamp '2030-01-01 00:00:00', count(*) from events where event_type = 'click'""")
def _late(spark, folder):
    """Three batches: all rows, then all clicks moved to 2030, then all rows again, too late by then.
    The watermark is a day: the second batch comes after it, and none of the third is counted."""
    files = scratch_path(spark, "late-events")
    out, checkpoint = scratch_path(spark, "late-windows"), scratch_path(spark, "late-checkpoint")
    for rows in _late_batches(spark, folder):
        rows.write.mode("append").parquet(files)
        hourly = window_stats(parquet_stream(spark, files), "ts", "value", "1 hour", late_by="1 day")
        drain(to_updates(hourly, out, checkpoint))
    final = latest_updates(spark.read.parquet(out), ["window_start"])
    return final.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "data_points")


def _late_batches(spark: SparkSession, folder: str) -> list[DataFrame]:
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    return [events, events.filter("event_type = 'click'").withColumn("ts", F.lit("2030-01-01").cast("timestamp_ntz")), events]


@query("str5_late_output", """
    select 'on time' as part, date_trunc('day', ts) as day, count(*) as n, sum(event_id)::bigint as ids from events group by all
    union all select 'on time', timestamp '2030-01-01', count(*), sum(event_id)::bigint from events where event_type = 'click'
    union all select 'late', date_trunc('day', ts), count(*), sum(event_id)::bigint from events group by all
    union all select 'logged late', null, count(*), null from events""")
def _late_output(spark, folder):
    """The same batches, parted: late rows are kept beside those that are on time, and the log counts them."""
    files, checkpoint = scratch_path(spark, "parted-events"), scratch_path(spark, "parted-checkpoint")
    parts = {k: LandedTable(spark, scratch_path(spark, f"parted-{k}")) for k in ("on time", "late")}

    def to(name):
        return lambda rows, load: LandedTable(rows.sparkSession, parts[name].root).append(rows, load)

    for rows in _late_batches(spark, folder):
        rows.write.mode("append").parquet(files)
        drain(part_late(parquet_stream(spark, files), "ts", "1 day", to("on time"), to("late"), checkpoint, "parted"))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    kept = [
        t.read().groupBy(F.lit(k).alias("part"), day).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
        for k, t in parts.items()
    ]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("day", "timestamp_ntz"), ("ids", "bigint"))]
    logged = late_log(spark, checkpoint).agg(F.sum("late").alias("n")).select(F.lit("logged late").alias("part"), none[0], "n", none[1])
    return kept[0].unionByName(kept[1]).unionByName(logged)


_FLOW = {
    "name": "split-events",
    "sources": [{"type": "file_csv", "id": "raw", "path": ""}],
    "transforms": [
        {"type": "clean_data", "id": "clean", "trim_strings": True, "normalize_case": "upper"},
        {"type": "sql_transform", "id": "people", "query": "SELECT * FROM input_data WHERE event_type <> 'ERROR'"},
        {
            "type": "sql_transform",
            "id": "faults",
            "query": "SELECT *, 'check' AS action FROM input_data WHERE event_type = 'ERROR'",
        },
    ],
    "sinks": [
        {"type": "iceberg", "id": "people-table", "table_name": "people", "bucket": "lake"},
        {"type": "iceberg", "id": "faults-table", "table_name": "faults", "bucket": "lake"},
    ],
    "edges": [
        ["raw", "clean"],
        ["clean", "people"],
        ["clean", "faults"],
        ["people", "people-table"],
        ["faults", "faults-table"],
    ],
}


@query("pip1_declared_flow", """
    select event_id, upper(event_type) as event_type, case event_type when 'error' then 'check' end as action,
           case event_type when 'error' then 'faults' else 'people' end as landed_in from events""")
def _flow(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type")
    done = run_flow(spark, _FLOW, inputs={"raw": events}, warehouse=scratch_path(spark, "warehouse"))
    landed = [
        LandedTable(spark, done[f"{name}-table"]).read().withColumn("landed_in", F.lit(name))
        for name in ("people", "faults")
    ]
    return landed[0].unionByName(landed[1], allowMissingColumns=True)
