"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content. A ledger records which rule versions have
scanned which blob, with what they found; a run scans unseen (blob, rule version) pairs only and
joins the findings of the current rules back to all paths that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import full_text, hot_keys, skewed_join, written


@dataclass(frozen=True)
class Rule:
    """A pattern of one kind of secret; the match, or its ``group``, must have ``least`` characters.

    Matches are the leftmost that do not overlap; one that fails still uses up its text. ``needs`` is
    a text without which nothing can match: it is looked for before the pattern.
    """

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    needs: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns of the base kinds, in their order.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, 0, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),  # a run shorter than this uses up nothing that could match
)
#: Kinds that the scan adds: block headers of private keys and tokens with a telling beginning.
MORE = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 0, "-----BEGIN "),
    Rule("signed_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1, 0, "eyJ"),
    Rule("hub_token", 1, r"gh[opsu]_[A-Za-z0-9]{36,}", 1, 0, "gh"),
    Rule("chat_token", 1, r"xox[abps]-[A-Za-z0-9-]{10,}", 1, 0, "xox"),
)
RULES = BASE + MORE

_LEDGER = "blob BINARY, rules ARRAY<STRING>, found ARRAY<STRUCT<rule: STRING, start: BIGINT, stop: BIGINT>>"


def spans(text: Column, rule: Rule) -> Column:
    """The rule's matches in a text as an array of (rule, start, stop) in code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    lengths = F.arrays_zip(
        F.transform(whole, F.char_length).alias("own"),
        F.transform(judged, F.char_length).alias("judged"),
        F.transform(F.slice(between, F.lit(1), F.size(whole)), F.char_length).alias("gap"),
    )
    none = F.array().cast("array<struct<rule:string,start:bigint,stop:bigint>>")

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        hit = F.array(
            F.struct(F.lit(rule.name).alias("rule"), start.alias("start"), (start + x["own"]).alias("stop"))
        )
        return F.struct(
            (start + x["own"]).alias("at"),
            F.when(x["judged"] >= rule.least, F.concat(done["found"], hit)).otherwise(done["found"]).alias("found"),
        )

    begin = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))
    found = F.aggregate(lengths, begin, step, lambda done: done["found"])
    return F.when(_may_match(text, rule), found).otherwise(none)


def _may_match(text: Column, rule: Rule) -> Column:
    """Cheap test before positions are worked out, first for a literal, then for the pattern."""
    matches = text.rlike(rule.pattern)
    return text.contains(rule.needs) & matches if rule.needs else matches


class Ledger:
    """Rows (blob, rules that scanned it, what they found) under a folder; only ever added to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LEDGER).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LEDGER)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)


def scan_versions(
    versions: DataFrame,
    ledger: Ledger,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per version: doc_id, blob, found (rule, start, stop of the current rules' matches).

    ``versions`` holds every version of every path (any id); equal texts are one blob and scanned
    once, by the rules that have not seen it. A null text is empty; rows that repeat get a row each;
    a null id is an id; an empty table gives no rows and adds nothing.
    """
    text = full_text(text_column)
    paths = written(
        versions.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("blob")), "scan-paths"
    )
    blobs = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("paths"), F.min("doc_id").alias("at"))
    seen = (
        ledger.read()
        .select("blob", F.explode("rules").alias("rule"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("seen"))
    )
    current = F.array(*[F.lit(r.name) for r in rules])
    todo = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
    blobs = written(blobs.join(seen, "blob", "left").withColumn("todo", todo).drop("seen"), "scan-blobs")

    # One version that holds an unseen blob brings its text: joined by blob and id, so that copies do not meet.
    own = versions.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("blob"), text.alias("text"))
    unseen = blobs.where("size(todo) > 0").select(F.col("blob").alias("b"), "at", "todo")
    texts = own.join(unseen, (F.col("blob") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("at")))
    none = F.array().cast("array<struct<rule:string,start:bigint,stop:bigint>>")
    parts = [
        F.when(F.array_contains("todo", rule.name), spans(F.col("text"), rule)).otherwise(none)
        for rule in rules
    ]
    scanned = texts.select("blob", F.col("todo").alias("rules"), F.concat(*parts).alias("found"))
    ledger.add(scanned.dropDuplicates(["blob"]))

    kept = lambda x: F.array_contains(current, x["rule"])
    findings = written(
        ledger.read()
        .where(F.size("found") > 0)
        .select("blob", F.explode("found").alias("f"))
        .distinct()
        .groupBy("blob")
        .agg(F.collect_list("f").alias("found"))
        .withColumn("found", F.filter("found", kept)),
        "scan-findings",
    )
    hot = hot_keys(blobs, ["blob"], "paths", max(1, paths.count()))
    return skewed_join(paths, findings, ["blob"], hot, "left").withColumn("found", F.coalesce("found", none))


def joined(found: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the kinds named, by start, then in the order of ``kinds``, with commas."""
    kind = lambda x: F.split_part(x["rule"], F.lit("@"), F.lit(1))
    names = F.array(*[F.lit(k) for k in kinds])
    wanted = F.filter(found, lambda x: F.array_contains(names, kind(x)))
    ordered = F.array_sort(
        F.transform(
            wanted,
            lambda x: F.struct(
                x["start"].alias("start"), F.array_position(names, kind(x)).alias("place"), x["stop"].alias("stop")
            ),
        )
    )
    text = lambda s: F.concat_ws(":", F.element_at(names, s["place"].cast("int")), s["start"], s["stop"])
    return F.array_join(F.transform(ordered, text), ",")


def new_ledger(spark: SparkSession) -> Ledger:
    """A ledger that begins empty, in the shared folder."""
    return Ledger(spark, scratch_path(spark, "ledger"))
