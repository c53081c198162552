"""Exact duplicates by skew-safe combining.

Each partition first drops its own copies, the digest groups are then merged in salted parts, and
the salts' winners are combined globally. Every stage groups by the digest *and* the full content,
so equal digests of different contents never merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, SPACES, full_text, hot_keys, named, numbered, row_number, skewed_join, written

SALTS = 32


def normalised(column: str = "text") -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(full_text(column), SPACES, " ")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def winners(contents: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per (digest, content) of frame (doc_id, digest, content): keep_id and group_size.

    The salt is the input partition's, so Spark's partial aggregation before the first shuffle
    leaves one row per content and partition; a content of any frequency then reaches a merging
    task as one row per partition, and the last task as one row per salt.
    """
    salted = (
        contents.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return salted.groupBy("digest", "content").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def dedup_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row (its number
    if ``docs`` is ``numbered``, else its place in a scan).

    Texts are equal when identical after white-space runs become one space; null counts as empty.
    Of equal texts the smallest id stays; a null id stays only if the group has no other (keep_id
    is then null). Rows that repeat id and text count each in group_size, and one of them stays.
    An empty table gives no rows; other columns are ignored.
    """
    content = normalised(text_column)
    rows = written(
        docs.select(
            row_number(docs).alias("row"),
            F.col(id_column).alias("doc_id"),
            digest(content).alias("digest"),
            F.sha2(content, 256).alias("text_sha256"),
        ),
        "exact-rows",
    )
    contents = docs.select(
        row_number(docs).alias("row"), F.col(id_column).alias("doc_id"), digest(content).alias("digest"), content.alias("content")
    )
    best = written(winners(contents, salts).drop("content"), "exact-winners")
    shared = best.groupBy("digest").count().where("count > 1").select("digest")
    if shared.isEmpty():
        return _judged(rows, best, ["digest"])
    shared = written(shared, "exact-collisions")
    alone = _judged(
        rows.join(shared, "digest", "left_anti"), best.join(shared, "digest", "left_anti"), ["digest"]
    )
    # Different contents under one digest: these documents alone are told apart by their full texts.
    texts = written(
        contents.withColumn("text_sha256", F.sha2("content", 256))
        .join(shared, "digest", "left_semi"),
        "exact-collided",
    )
    return alone.unionByName(_judged(texts, winners(texts, salts), ["digest", "content"]))


def _judged(rows: DataFrame, best: DataFrame, key: list[str]) -> DataFrame:
    """Each row with its class's winner; of rows repeating the winner's id the first one stays."""
    repeated = (
        rows.groupBy(*key, "doc_id")
        .agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(*key, F.col("doc_id").alias("same_id"), "first_row")
    )
    b, r = best.alias("b"), repeated.alias("r")
    same = F.col("b.keep_id").eqNullSafe(F.col("r.same_id"))
    for k in key:
        same = same & (F.col(f"b.{k}") == F.col(f"r.{k}"))
    best = b.join(r, same, "left").select("b.*", "r.first_row")
    hot = hot_keys(best, key, "group_size", rows.count())
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (
        F.col("first_row").isNull() | (F.col("row") == F.col("first_row"))
    )
    return skewed_join(rows, best, key, hot).select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256", "row"
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that ``dedup_classes`` keeps, with their own columns and texts.

    Rows are numbered once and found again by number, so that even a row repeated very often is
    shuffled once per copy and evenly.
    """
    own = numbered(docs)
    kept = dedup_classes(own, id_column, text_column).where("kept").select(F.col("row").alias(ROW))
    return own.join(kept, ROW, "left_semi").select(*[named(c) for c in docs.columns])
