"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt to permuted blocks of about equal size. A source gives whole
passes over its blocks and, for the rest of its target, the first blocks of another permutation,
the last one cut between documents. The numbers of blocks that the sources give are split down
a binary tree of output shards: at each node the left half gets a sample without replacement of
the node's blocks, so each shard's quotas per source are exact. A shard then takes its quota of
each source's permuted blocks, all disjoint, and is shuffled by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import ROW, WORD, fresh, full_text, hot_keys, named, named_key, numbered, row_number, skewed_join, unit, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix over words of all sources.
TOTAL_SHARE = 1.5
#: Most times that a document is taken.
MOST_TIMES = 2
SHARDS = 16
#: There are so many blocks per shard at least, and a block has about so many words at most.
BLOCKS_PER_SHARD = 32
BLOCK_WORDS = 4_000_000
SEED = 20240


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Sources (host, source) with their rank from 0 in code-point order, null last.

    Ranges of sources are numbered apart and shifted by the counts of the ranges before.
    """
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    ranges = written(
        sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "source-ranges"
    )
    counts = ranges.groupBy("part").count()
    before = counts.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before")
    )  # a row per range
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranges.withColumn("place", place).join(F.broadcast(before), "part").select(
        "host", "source", "source_size", "source_docs", (F.col("place") + F.col("before")).alias("rank")
    )


def with_targets(sources: DataFrame, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """Sources with ``target``: ``share`` of all sizes by weight, at most ``most`` times the own size.

    What a source cannot take is reshared by weight. Each round fixes the sources whose share
    exceeds their limit; only sums come to the driver.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = written(
        sources.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))).withColumn(
            "limit", F.col("source_size").cast("double") * most
        ),
        "source-weights",
    )
    total = float(sources.select(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("weight") * level > F.col("limit")
        capped, weight = sources.select(
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not weight:
            break
        now = max(0.0, total - capped) / weight
        if now <= level:
            break
        level = now
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("limit")))


def split_quotas(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """(host, shard, quota, first): how many of its blocks a source gives to each shard.

    ``units`` has a host's number of blocks. A node's tickets, one per block, are ordered by a hash
    that is new at each level, and the left shards get their exact share of them: a multivariate
    hypergeometric draw. ``first`` is where the shard's blocks begin in the source's permutation.
    Tickets are numbered in even ranges of the order, so a node of very many is not one task's work.
    """
    node = units.where("units > 0").select(
        "host", F.lit(0).alias("low"), F.lit(shards).alias("high"), F.col("units").cast("long").alias("quota")
    )
    width, level = shards, 0
    while width > 1:
        tickets = node.select("host", "low", "high", F.explode(F.sequence(F.lit(1), F.col("quota"))).alias("ticket"))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        draw = F.xxhash64(F.lit(seed), F.lit(level), "low", "host", "ticket")
        placed = number_rows(tickets.withColumn("draw", draw), ["low", "high"], ["draw", "host", "ticket"], "place")
        here = node.groupBy("low", "high").agg(F.sum("quota").alias("here"))  # a row per node, of which there are few
        share = F.round(F.col("here") * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        left = (F.col("place") <= share) & (middle > F.col("low"))
        node = (
            placed.join(F.broadcast(here), ["low", "high"])
            .select("host", "low", "high", middle.alias("middle"), left.alias("left"))
            .groupBy(
                "host",
                F.when(F.col("left"), F.col("low")).otherwise(F.col("middle")).alias("low"),
                F.when(F.col("left"), F.col("middle")).otherwise(F.col("high")).alias("high"),
            )
            .agg(F.count(F.lit(1)).alias("quota"))
        )
        width, level = (width + 1) // 2, level + 1
    first = F.sum("quota").over(Window.partitionBy("host").orderBy("low")) - F.col("quota")
    return node.select("host", F.col("low").alias("shard"), "quota", first.alias("first"))


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_times: int = MOST_TIMES,
    shards: int = SHARDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    tree_seed: int | None = None,
) -> DataFrame:
    """The mix, one row per time a row is taken (and one, with a null shard, for a row not taken).

    Columns: row (its number if ``docs`` is ``numbered``, else its place in a scan), doc_id, size, source, source_size, target, time, shard,
    place (order within the shard, by a hash). The size is the number of words. A source's words
    taken differ from its target by less than its last document's size. Everything depends on
    the rows' values (but for maps and variants), their number among equal rows and the seed only, so
    reruns agree, whatever the order and the splits of a scan.

    A null text has size 0, a null source is one source and comes last; rows that repeat are mixed
    each for itself; a source without words has target 0 and gives nothing; an empty table gives
    no rows.
    """
    kinds = [(c, kind) for c, kind in docs.dtypes if c != ROW and "map<" not in kind and "variant" not in kind]
    values = [x for c, _ in kinds for x in (named(c), named(c).isNull())]
    rows = written(
        docs.select(
            row_number(docs).alias("row"),
            F.col(id_column).alias("doc_id"),
            F.regexp_count(full_text(text_column), F.lit(WORD)).cast("long").alias("size"),
            F.col(source_column).alias("source"),
            named_key(source_column).alias("host"),
            F.xxhash64(F.lit(1), *values).alias("h1"),
            F.xxhash64(F.lit(2), *values).alias("h2"),
        ),
        "mix-rows",
    )
    rows = _with_copies(rows)
    sums = rows.groupBy("host", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    sources = with_targets(ranked_sources(sums), weights, total_share, most_times)
    sources = _block_counts(sources, shards * blocks_per_shard, block_words)
    hot = hot_keys(sources, ["host"], "source_docs", max(1, rows.count()))

    draw = unit(F.lit(seed), "h1", "h2", "copy")
    dealt = skewed_join(rows, sources.drop("source", "source_docs", "rank", "weight", "limit"), ["host"], hot)
    dealt = written(
        dealt.withColumn("draw", draw).withColumn("block", F.floor(F.col("draw") * F.col("blocks")).cast("long")),
        "mix-dealt",
    )
    cut = _drawn_blocks(dealt, sources, seed)
    taken = _times(dealt, cut)

    # Blocks that each pass takes, numbered in the source's permutation of all of them.
    uses = (
        taken.where("times > 0")
        .select("host", "block", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time"))
        .groupBy("host", "block", "time")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    order = Window.partitionBy("host").orderBy(F.xxhash64(F.lit(seed + 1), "block", "time"), "block", "time")
    uses = written(uses.withColumn("number", F.row_number().over(order) - 1), "mix-blocks")
    quotas = split_quotas(uses.groupBy("host").agg(F.count(F.lit(1)).alias("units")), shards, seed if tree_seed is None else tree_seed)
    shard_of = (
        uses.join(quotas, "host")
        .where("number >= first and number < first + quota")
        .select("host", "block", "time", "shard")
    )
    rows_taken = taken.select(
        "row", "doc_id", "size", "source", "source_size", "target", "host", "block", "h1", "h2", "copy",
        F.explode_outer(F.when(F.col("times") > 0, F.sequence(F.lit(1), F.col("times")))).alias("time"),
    )
    return rows_taken.join(shard_of, ["host", "block", "time"], "left").select(
        "row", "doc_id", "size", "source", "source_size", "target", "time", "shard",
        F.xxhash64(F.lit(seed + 2), "h1", "h2", "copy", "time").alias("place"),
    )


def _with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: a number among rows of equal values (``h1``, ``h2``), 1 for a row without equals."""
    repeated = written(
        rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mix-repeated"
    )
    if repeated.isEmpty():
        return rows.withColumn("copy", F.lit(1).cast("long"))
    alone = rows.join(repeated, ["h1", "h2"], "left_anti").withColumn("copy", F.lit(1).cast("long"))
    hot = hot_keys(repeated, ["h1", "h2"], "n", rows.count())
    equal = skewed_join(rows, repeated, ["h1", "h2"], hot).select(rows.columns)
    return written(alone.unionByName(number_rows(equal, ["h1", "h2"], ["row"], "copy")), "mix-numbered")


def _block_counts(sources: DataFrame, blocks: int, block_words: int) -> DataFrame:
    """Blocks of each source, by size: ``blocks`` in all or more, of ``block_words`` or less, each source one."""
    total = sources.select(F.sum("source_size")).first()[0] or 0
    words = max(1.0, min(total / blocks, float(block_words)))
    count = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(words))).cast("long")
    rest = F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")
    empty = F.col("source_size") == 0
    return written(
        sources.withColumn("blocks", count)
        .withColumn("whole", F.when(empty, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int"))
        .withColumn("rest", F.when(empty, 0.0).otherwise(rest)),
        "mix-sources",
    )


def _drawn_blocks(dealt: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """(host, block, before): blocks that the rest of a target reaches, and the words before them.

    There are as many rows as blocks, a bounded number per source.
    """
    sizes = dealt.groupBy("host", "block").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
    order = Window.partitionBy("host").orderBy(F.xxhash64(F.lit(seed + 3), "block"), "block")
    before = F.sum("words").over(order) - F.col("words")
    return written(
        sizes.withColumn("before", before)
        .where("before < rest")
        .select("host", "block", "before", (F.col("before") + F.col("words") > F.col("rest")).alias("cut")),
        "mix-drawn",
    )


def _times(dealt: DataFrame, drawn: DataFrame) -> DataFrame:
    """``dealt`` with ``times``: the whole passes, and one more for a row drawn for the rest.

    Of a source's one block that reaches over its rest, documents are taken in the order of their
    draw while at least half of them fits.
    """
    marked = dealt.join(drawn.where("not cut").select("host", "block", F.lit(1).alias("more")), ["host", "block"], "left")
    last = dealt.join(drawn.where("cut").drop("cut"), ["host", "block"])
    upto = F.sum("size").over(Window.partitionBy("host", "block").orderBy("draw", "h1", "h2", "copy"))
    last = last.withColumn("upto", upto).where(
        F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("rest")
    )
    last = last.select("row", F.lit(1).alias("cut_more"))
    return written(
        marked.join(last, "row", "left").withColumn(
            "times", F.col("whole") + F.coalesce("more", "cut_more", F.lit(0))
        ),
        "mix-times",
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix in the columns of ``docs``; a row taken twice comes twice.

    They come shard by shard, and shuffled within each: partitions are ranges of (shard, place), so
    what is written has the shards one after the other.
    """
    own = numbered(docs)
    shard, place = fresh(docs.columns, "shard"), fresh(docs.columns, "place")
    taken = mix_sources(own, **settings).where("shard is not null")
    taken = taken.select(F.col("row").alias(ROW), F.col("shard").alias(shard), F.col("place").alias(place))
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    mixed = own.join(taken, ROW).repartitionByRange(parts, shard, place).sortWithinPartitions(shard, place)
    return mixed.select(*[named(c) for c in docs.columns])


def write_shards(spark: SparkSession, mixed: DataFrame, path: str) -> None:
    """Write a mix as one folder per shard, each shuffled locally by ``place``."""
    mixed.where("shard is not null").repartition("shard").sortWithinPartitions("shard", "place").write.partitionBy(
        "shard"
    ).parquet(path)
