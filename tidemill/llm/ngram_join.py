"""N-gram Jaccard self-join by MinHash banding.

Band and row counts follow from the target recall at the threshold; texts are shuffled on band
hashes, and the pairs of a bucket are verified on their full n-gram sets inside the task, each
pair in the first band that it shares only. Pairs are never emitted: a task returns links per text
and a spanning forest of the links it found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, full_text, hot_keys, named, numbered, skewed_join, python_tasks, written
from .components import components
from .words import mixed, shingles

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
#: Texts and bytes of text that one side of a verification task holds.
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20

_RESULT = ["doc_id", "class_id", "n_links", "row", "component"]


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows for which ``most`` hashes give the recall at the threshold.

    A pair of similarity s meets in a band with probability 1 - (1 - s**rows)**bands; more rows
    mean fewer false candidates.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return seeds[:n] | np.uint64(1), seeds[n:]


def band_hashes(texts: pa.Array, size: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts that have n-grams, their band hashes, the digest of each such text's n-gram set)."""
    owner, grams = shingles(texts, size)
    present, first = np.unique(owner, return_index=True)
    if not len(present):
        return present, np.zeros((0, bands), np.uint64), np.zeros((0, 2), np.uint64)
    multiply, add = _multipliers(bands * rows)
    out = np.zeros((len(present), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(present), band + 1, np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((grams ^ add[k]) * multiply[k], first)
            key = mixed(key * np.uint64(31) + least)
        out[:, band] = key
    lengths = np.diff(np.append(first, len(grams))).astype(np.uint64)
    sets = np.stack([np.add.reduceat(mixed(grams), first), np.add.reduceat(mixed(grams ^ add[0]), first) ^ lengths], 1)
    return present, out, sets


def _sign(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            present, keys, sets = band_hashes(texts, size, bands, rows)
            n = len(texts)
            full = np.zeros((n, bands), np.int64)
            full[present] = keys.view(np.int64)
            digest = np.zeros((n, 2), np.int64)
            digest[present] = sets.view(np.int64)
            has = np.zeros(n, bool)
            has[present] = True
            ends = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(digest[:, 0]),
                    pa.array(digest[:, 1]),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(full[has].ravel())),
                ],
                ["row", "doc_id", "bytes", "d1", "d2", "bands"],
            )

    return run


def grouped(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups of a partition sorted by ``key``, several small groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Union-find over a bucket's texts."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def bucket_links(
    grams: list[np.ndarray], side: np.ndarray, alone: bool, keys: np.ndarray, band: int, copies: np.ndarray,
    threshold: tuple[int, int],
) -> tuple[np.ndarray, np.ndarray]:
    """(links of each text, its root in the forest of links) among a bucket's texts.

    ``side`` is 0 or 1: texts of side 0 meet those of side 1, which may have none, or each other if
    the task is of one block (``alone``).
    A pair counts only where ``band`` is the first band whose key both share. Links count the
    partner's copies. The similarity test is on whole numbers: up * common >= down * union.
    """
    n = len(grams)
    up, down = threshold[1], threshold[0]
    sizes = np.array([len(g) for g in grams])
    links = np.zeros(n, np.int64)
    forest = _Forest(n)
    left = np.arange(n) if alone else np.flatnonzero(side == 0)
    right = left if alone else np.flatnonzero(side == 1)
    place = np.full(n, -1)
    place[right] = np.arange(len(right))
    # Postings of the right side: for each n-gram the texts that have it.
    values = np.concatenate([grams[i] for i in right]) if len(right) else np.zeros(0, np.uint64)
    holders = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(values, kind="stable")
    values, holders = values[order], holders[order]
    for x in left:
        possible = np.ones(len(right), bool)
        if alone:
            possible[: x + 1] = False
        if band and possible.any():
            possible &= ~(keys[right, :band] == keys[x, :band]).any(axis=1)
        if not possible.any():
            continue
        lo, hi = np.searchsorted(values, grams[x]), np.searchsorted(values, grams[x], side="right")
        spans = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
        common = np.bincount(holders[at], minlength=len(right))
        near = possible & (up * common >= down * (sizes[x] + sizes[right] - common)) & (common > 0)
        hits = right[near]
        if len(hits):
            links[x] += copies[hits].sum()
            links[hits] += copies[x]
            for y in hits:
                forest.join(int(x), int(y))
    return links, np.array([forest.root(i) for i in range(n)])


def _verify(size: int, threshold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task", 64):
            task = table.column("task").to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(task)) + 1, [len(task)]])
            texts = table.column("text").combine_chunks()
            texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
            owner, grams = shingles(texts, size)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            row, side = table.column("row").to_numpy(), table.column("side").to_numpy()
            band, copies = table.column("band").to_numpy(), table.column("copies").to_numpy()
            alone = table.column("alone").to_numpy(zero_copy_only=False)
            keys = np.array(table.column("bands").to_pylist(), np.int64)
            rows, links, roots = [], [], []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a < 2:
                    continue
                own = [grams[bounds[i] : bounds[i + 1]] for i in range(a, b)]
                found, root = bucket_links(own, side[a:b], bool(alone[a]), keys[a:b], int(band[a]), copies[a:b], threshold)
                hit = np.flatnonzero(found)
                rows.append(row[a:b][hit])
                links.append(found[hit])
                roots.append(row[a:b][root[hit]])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (rows, links, roots)], ["row", "links", "root"]
                )

    return run


def ngram_join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, row (its number, see ``numbered``), component.

    Two texts are linked if the Jaccard similarity of their sets of ``size`` words in a row is at
    least ``threshold``; n_links counts the other documents linked, copies included. A class is a
    connected component of links, named by its least doc_id (null only if all its ids are null);
    ``component`` names it by a row of it.
    Texts of fewer words have one n-gram, all their words; texts without words (or null) have no
    links and are classes of their own. Rows that repeat are copies; an empty table gives no rows.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    bands, rows_per_band = bands_for(threshold, recall)
    ratio = threshold.as_integer_ratio() if threshold in (0.5, 0.75, 1.0) else (round(threshold * 1000), 1000)
    # Texts are read again for the verification, by the rows that the hashes were made of.
    texts_only = docs if ROW in docs.columns else docs.select(*dict.fromkeys([id_column, text_column]))
    base = numbered(texts_only).select(
        F.col(ROW).alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        full_text(text_column).alias("text"),
    )
    signed = written(
        base.mapInArrow(_sign(size, bands, rows_per_band), "row LONG, doc_id LONG, bytes LONG, d1 LONG, d2 LONG, bands ARRAY<LONG>"),
        "minhash",
    )
    # Equal n-gram sets (128 bits of digest and the size agree) are one text with copies.
    texts = written(
        signed.where("size(bands) > 0")
        .groupBy("d1", "d2")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")),
        "texts",
    )
    nodes = texts.select("node", "copies").join(signed.select(F.col("row").alias("node"), "bytes", "bands"), "node")
    keyed = written(nodes.select("node", "bytes", F.posexplode("bands").alias("band", "key")), "band-keys")
    # Buckets of the same texts in several bands are one: a pair is verified in its first band.
    buckets = (
        keyed.groupBy("band", "key")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bucket_bytes"), F.min("node").alias("least"),
            F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("h1"),
            F.sum(F.xxhash64(F.lit(7), "node").cast("decimal(20,0)")).alias("h2"),
        )
        .where("n > 1")
        .groupBy("n", "least", "h1", "h2")
        .agg(F.min(F.struct("band", "key")).alias("first"), F.max("bucket_bytes").alias("bucket_bytes"))
        .select("first.band", "first.key", "n", "bucket_bytes")
    )
    buckets = written(buckets, "buckets")
    hot = hot_keys(buckets, ["band", "key"], "n", max(1, texts.count() * bands))
    members = written(skewed_join(keyed.drop("bytes"), buckets, ["band", "key"], hot), "members")

    found = _linked(docs, base, nodes, members, size, ratio, block_rows, block_bytes)
    forest = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("row").alias("node")).agg(F.sum("links").alias("links"))
    labelled = written(
        texts.join(forest, "node", "left").withColumn("component", F.coalesce("component", "node")), "labelled"
    )
    names = written(
        labelled.groupBy("component").agg(F.min("least_id").alias("class_id"), F.count(F.lit(1)).alias("n")), "names"
    )
    large = hot_keys(names, ["component"], "n", max(1, labelled.count()))
    classes = written(
        skewed_join(labelled, names.drop("n"), ["component"], large)
        .join(links, "node", "left")
        .select(
            "d1", "d2", "class_id", "copies", "component",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        ),
        "classes",
    )
    slim = signed.select("row", "doc_id", "d1", "d2", (F.size("bands") > 0).alias("has"))
    many = hot_keys(classes, ["d1", "d2"], "copies", max(1, signed.count()))
    linked = skewed_join(slim.where("has"), classes, ["d1", "d2"], many).select(*_RESULT)
    none = slim.where("not has").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "row",
        F.col("row").alias("component"),
    )
    return linked.unionByName(none)


def _linked(docs, base, nodes, members, size, ratio, block_rows, block_bytes) -> DataFrame:
    """(row, links, root): what the verification tasks found, written."""
    # A bucket of over block_rows texts is cut into blocks by hash; each pair of blocks is a task.
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("bucket_bytes") / block_bytes)).cast("int")
    pieces = members.select("node", "band", "key", blocks.alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int")
    )
    tasks = pieces.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node",
        "band",
        F.xxhash64("band", "key", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
        (F.col("block") == F.col("other")).alias("alone"),
    )
    # Each text meets its own list of tasks once, so a whole text is shuffled to find its tasks once.
    wanted = tasks.groupBy("node").agg(F.collect_list(F.struct("task", "side", "alone", "band")).alias("tasks"))
    wanted = written(wanted.join(nodes.drop("bytes"), "node"), "verify-tasks")
    given = (
        base.select(F.col("row").alias("node"), "text")
        .join(wanted, "node")
        .select(F.explode("tasks").alias("t"), F.col("node").alias("row"), "copies", "bands", "text")
        .select("t.task", "t.side", "t.alone", "t.band", "row", "copies", "bands", "text")
    )
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(
        given.repartition(parts, "task")
        .sortWithinPartitions("task")
        .mapInArrow(_verify(size, ratio), "row LONG, links LONG, root LONG"),
        "links",
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One document of each class: that with the least id (of rows repeating it, the first)."""
    own = numbered(docs)
    kept = (
        ngram_join(own, id_column, text_column, **settings)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
        .select(F.col("first.row").alias(ROW))
    )
    return own.join(kept, ROW, "left_semi").select(*[named(c) for c in docs.columns])
