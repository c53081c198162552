"""Phrase collocations from counting quotient filters.

1. Documents of one language are gathered to shards as they are read. A shard is its tokens, as
   numbers in its own dictionary, and the dictionary with counts: texts are read once.
2. Dictionaries are added up. Frequent words get ids per language; a shard's dictionary is joined with
   them and its tokens become ids. A phrase is only as frequent as its words, so others part phrases.
3. For 2, 3, ... words: each shard counts its n-grams in a counting quotient filter (see
   ``quotient_filter``) and sends it in slices; sorted filters of one slice are merged across shards.
   A slice that is too large for one task is merged for some shards at a time and cut into finer
   slices, as often as needed, so rows and bytes sent stay in proportion to the input.
   Only n-grams of which both (n-1)-grams may be frequent are counted: a bitmap of fixed size, hashed
   from the frequent ones, goes to all tasks. Its false hits cost time, not results.
4. Candidates are scored and tested against longer ones by joins on their ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from . import quotient_filter as qf
from .byte_words import byte_classes, byte_words
from .common import full_text, hot_keys, python_tasks, skewed_join, written
from .words import mixed

SPACES, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
LONGEST = 4
MIN_COUNT = 30
#: A candidate goes if a longer one that contains it has this percentage of its count.
INSIDE_SHARE = 80
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
#: Bytes of text in a shard, about, and bytes that a task gathers for all its languages. A task's arrays are
#: several times a shard, and a shard's tokens are one row: executors' memory follows this number.
SHARD_BYTES = 4 << 20
HELD_BYTES = 48 << 20
#: Keys of a slice, about, and the bits by which slices get finer per round.
SLICE_KEYS = 2 << 20
FAN_BITS = 6
#: Bytes of an Arrow batch between Spark and a Python task, or one row: tokens and filters are long rows.
SENT_BYTES = 1 << 20
#: Bits of the bitmap of frequent n-grams: 8 MB, whatever the corpus.
BITMAP_BITS = 26
#: Parts in which a language's candidates are ranked first.
RANK_PARTS = 64
#: Most bits of a word id.
ID_BITS = 32

_KINDS = byte_classes(SPACES, BREAKS)
_SHARD = pa.schema(
    [("shard", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("code", pa.int32()), ("uses", pa.int64()),
     ("tokens", pa.binary())]
)
_SHARD_SQL = "shard LONG, lang STRING, word STRING, code INT, uses LONG, tokens BINARY"
WORDS_A_BATCH = 50_000


def _sent(df: DataFrame, label: str, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``written``, with Arrow batches of ``sent_bytes`` or of one row meanwhile; Spark's own are 64 MB."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key, None)  # none if nobody set it
    conf.set(key, str(sent_bytes))
    try:
        return written(df, label)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _SHARD], schema=_SHARD)


def _zipped(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").tobytes())


def _unzipped(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4")


def _shard(number: int, lang: str, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """A shard's rows: its tokens (code + 1, and 0 before each piece of text), and its dictionary."""
    words, _, follows = byte_words(pa.concat_arrays(texts), _KINDS)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    n, one = len(coded.dictionary), lambda x: pa.array([x])
    tokens = np.zeros(len(codes) + int((~follows).sum()), np.uint32)
    tokens[np.arange(len(codes)) + np.cumsum(~follows)] = codes + 1
    yield _rows(1, shard=one(number), lang=one(lang), tokens=pa.array([_zipped(tokens)], pa.binary()))
    uses = np.bincount(codes, minlength=n)
    for a in range(0, n, WORDS_A_BATCH):
        m = len(uses[a : a + WORDS_A_BATCH])
        yield _rows(
            m, shard=pa.array(np.full(m, number)), lang=pa.array([lang] * m), word=coded.dictionary.slice(a, m),
            code=pa.array(np.arange(a, a + m, dtype=np.int32)), uses=pa.array(uses[a : a + m]),
        )


def _gather(shard_bytes: int, held_bytes: int):
    """Documents to shards of one language; a shard is numbered by the first of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, list[pa.Array]]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                own = batch.filter(pc.equal(langs, lang))
                held.setdefault(lang, (own.column("row")[0].as_py(), []))[1].append(own.column("text"))
                size[lang] = size.get(lang, 0) + pc.sum(pc.binary_length(own.column("text"))).as_py()
                while size and (size.get(lang, 0) >= shard_bytes or sum(size.values()) >= held_bytes):
                    most = max(size, key=size.get)
                    del size[most]
                    number, texts = held.pop(most)
                    yield from _shard(number, most, texts)
        for lang, (number, texts) in held.items():
            yield from _shard(number, lang, texts)

    return run


def _encode(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """A shard's tokens as ids + 1, with one 0 between runs of frequent words."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("ids", pa.binary()), ("n", pa.int64())])
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    tokens = _unzipped(left.column("tokens")[0].as_py())
    table = np.zeros(int(tokens.max(initial=0)) + 1, np.uint32)
    table[right.column("code").to_numpy() + 1] = right.column("id").to_numpy() + 1
    ids = table[tokens]
    stays = ids > 0
    stays[1:] |= ids[:-1] > 0
    ids = ids[stays]
    row = (left.column("shard")[0].as_py(), left.column("lang")[0].as_py(), _zipped(ids), int((ids > 0).sum()))
    return pa.table([pa.array([x], t.type) for x, t in zip(row, schema)], schema=schema)


def _bit(top: np.ndarray, low: np.ndarray | None, lang: str, bits: int) -> np.ndarray:
    """The place of an n-gram in the bitmap."""
    salt = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
    key = mixed(top ^ salt)
    if low is not None:
        key = mixed(key ^ low)
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def _count(n: int, id_bits: int, prefix: int, bitmap: np.ndarray | None, bitmap_bits: int):
    """Each shard's n-grams as filters, one per slice."""

    def keys(ids, at, size):
        return qf.packed_grams([ids[at + k] - 1 for k in range(size)], id_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "ids"))):
                ids = _unzipped(data)
                size = len(ids) - n + 1
                if size <= 0:
                    continue
                whole = np.ones(size, bool)
                for k in range(n):
                    whole &= ids[k : k + size] > 0
                at = np.flatnonzero(whole)
                if bitmap is not None:
                    for step in (0, 1):
                        place = _bit(*keys(ids, at + step, n - 1), lang, bitmap_bits)
                        at = at[bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0]
                if not len(at):
                    continue
                found = qf.slices(*qf.counted(*qf.permuted(*keys(ids, at, n), n * id_bits)), n * id_bits, prefix)
                yield from _filters(shard, lang, found)

    return run


def _filters(shard: int, lang: str, found: list[tuple[int, bytes]], sent_bytes: int = SENT_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of a shard's (slice, filter), in batches of ``sent_bytes`` or of one filter."""
    ends = np.cumsum([len(x) for _, x in found])
    a = 0
    while a < len(found):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + sent_bytes, side="right")))
        numbers, filters = zip(*found[a:b])
        m = b - a
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard] * m, pa.int64()), pa.array([lang] * m, pa.string()), pa.array(numbers, pa.int64()), pa.array(filters, pa.binary())],
            ["shard", "lang", "slice", "filter"],
        )
        a = b


def _merge(bits: int, prefix: int, finer: int):
    """Filters of one slice and some shards merged, and cut by ``finer`` more bits."""

    def run(key, table):
        lang, number, batch = (x.as_py() for x in key)
        sums = qf.merged(table.column("filter").to_pylist(), bits, prefix, number)
        return pa.Table.from_batches(_filters(batch, lang, qf.slices(*sums, bits, prefix + finer)))

    return run


def _frequent(n: int, id_bits: int, prefix: int, least: int, bitmap_bits: int):
    """The n-grams of one slice with ``least`` uses or more."""

    def run(key, table):
        lang, number = (x.as_py() for x in key)
        top, low, counts = qf.merged(table.column("filter").to_pylist(), n * id_bits, prefix, number)
        often = counts >= least
        top, low = qf.restored(top[often], None if low is None else low[often], n * id_bits)
        ids = np.stack(qf.unpacked_grams(top, low, n, id_bits), 1)
        m = len(ids)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * m + 1, n), pa.int32()), pa.array(ids.ravel()))
        return pa.table(
            {"lang": pa.array([lang] * m, pa.string()), "ids": lists, "uses": pa.array(counts[often]),
             "bit": pa.array(_bit(top, low, lang, bitmap_bits))}
        )

    return run


def count_grams(
    encoded: DataFrame, n: int, id_bits: int, least: int, bitmap: np.ndarray | None,
    slice_keys: int = SLICE_KEYS, fan_bits: int = FAN_BITS, bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """(lang, ids, uses, bit) of the n-grams of ``encoded`` shards with ``least`` uses or more, written."""
    tokens, shards = encoded.agg(F.sum("n"), F.count(F.lit(1))).first()
    bits = n * id_bits
    # An n-gram is at most a key per token; there is no finer slice than one key.
    total = min(qf.top_bits(bits), max(0, math.ceil(math.log2(max(1, (tokens or 0) / slice_keys)))))
    prefix = min(fan_bits, total)
    schema = "shard LONG, lang STRING, slice LONG, filter BINARY"
    rows = encoded.select("shard", "lang", "ids").mapInArrow(_count(n, id_bits, prefix, bitmap, bitmap_bits), schema)
    while prefix < total:
        # As many shards together as there are slices a round: a group's bytes stay those of a shard.
        shards = max(1, -(-shards // (1 << fan_bits)))
        finer = min(fan_bits, total - prefix)
        batch = F.pmod(F.xxhash64("shard"), F.lit(shards))
        rows = rows.groupBy("lang", "slice", batch.alias("batch")).applyInArrow(_merge(bits, prefix, finer), schema)
        prefix += finer
    found = rows.groupBy("lang", "slice").applyInArrow(
        _frequent(n, id_bits, prefix, least, bitmap_bits), "lang STRING, ids ARRAY<LONG>, uses LONG, bit LONG"
    )
    return _sent(found, f"grams-{n}")


def bitmap_of(grams: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """The bitmap of the n-grams' places: 2**bits bits, whatever their number."""
    place = F.col("bit") + 1
    parts = grams.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("part")
    )
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for r in parts.collect():  # one row per 32,768 bits
        own = np.frombuffer(bytes(r["part"]), np.uint8)
        start = (r["bucket"] - 1) * len(own)
        out[start : start + len(own)] = own[: len(out) - start]
    return out


def _scored(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """Candidates (lang, ids, a) with l, r and score of their lowest-scoring cut."""
    cuts = candidates.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    rest = F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))
    sides = F.explode(F.array(*[F.struct(F.lit(i).alias("side"), x.alias("part")) for i, x in enumerate((F.slice("ids", 1, F.col("k")), rest))]))
    parts = written(cuts.withColumn("x", sides).select("lang", "ids", "a", "k", "x.side", "x.part"), "phrase-parts")
    hot = hot_keys(parts.groupBy("lang", "part").count(), ["lang", "part"], "count", max(1, parts.count()))
    found = skewed_join(parts, counts, ["lang", "part"], hot)
    use = lambda side: F.sum(F.when(F.col("side") == side, F.col("uses")))
    whole = found.groupBy("lang", "ids", "a", "k").agg(use(0).alias("l"), use(1).alias("r"))
    score = F.expr(f"cast({scale} as decimal(19,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    return (
        whole.withColumn("score", score)
        .groupBy("lang", "ids", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "ids", "a", "low.l", "low.r", "low.score")
    )


def _not_inside(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates that no longer one contains with ``share`` percent of their uses."""
    n = F.size("ids")
    spans = F.flatten(
        F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.slice("ids", i, m)))
    )
    longer = (
        candidates.where(n > 2)
        .select("lang", "a", F.explode(spans).alias("ids"))
        .groupBy("lang", "ids")
        .agg(F.max("a").alias("most"))
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return candidates.join(longer, ["lang", "ids"], "left").where(
        F.col("most").isNull() | (wide("most") * 100 < wide("a") * share)
    ).drop("most")


def collocations(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    inside_share: int = INSIDE_SHARE,
    scale: int = SCALE,
    top: int = TOP,
    shard_bytes: int = SHARD_BYTES,
    held_bytes: int = HELD_BYTES,
    id_bits: int = 0,
    **slicing,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are cut at ``BREAKS`` into pieces and these at ``SPACES`` into words, A-Z lower-cased. n counts
    the language's words; a, l and r the uses within pieces of the phrase and of its two parts at the
    cut of the lowest score, floor(scale * a / (l + r)), the first of equal ones. A phrase needs ``min_count``
    uses and no longer one that contains it with ``inside_share`` percent of them. The order is that of
    score and a, highest first, then of the phrase's bytes.

    A null language is ``und``, a null text empty; each row counts, repeated ones too; languages without
    phrases, and an empty table, give no rows. Word ids have ``id_bits`` bits or as many as the vocabulary
    needs; at most 32, which is 4 billion words of ``min_count`` uses in one language, and 128 bits a phrase.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG)).alias("lang"),
        full_text(text_column).alias("text"),
    )
    shards = _sent(given.mapInArrow(_gather(shard_bytes, held_bytes), _SHARD_SQL), "phrase-shards")
    dictionary = shards.where("word is not null").select("shard", "lang", "word", "code", "uses")
    totals = written(dictionary.groupBy("lang", "word").agg(F.sum("uses").alias("uses")), "phrase-words")
    sizes = totals.groupBy("lang").agg(F.sum("uses").alias("n"))
    words = number_rows(totals.where(F.col("uses") >= min_count), ["lang"], ["word"], "number")
    words = written(words.select("lang", "word", "uses", (F.col("number") - 1).alias("id")), "phrase-ids")
    id_bits = id_bits or max(1, int(words.agg(F.max("id")).first()[0] or 0).bit_length())
    assert id_bits <= ID_BITS and id_bits * longest <= 128, "more words than ids"

    mapping = dictionary.join(words.select("lang", "word", "id"), ["lang", "word"]).select(
        F.col("shard").alias("home"), "code", "id"
    )
    tokens = shards.where("tokens is not null").select("shard", "lang", "tokens")
    encoded = _sent(
        tokens.groupBy("shard").cogroup(mapping.groupBy("home")).applyInArrow(_encode, "shard LONG, lang STRING, ids BINARY, n LONG"),
        "phrase-tokens",
    )
    counts = words.select("lang", F.array("id").alias("part"), "uses")
    candidates, bitmap = None, None
    for n in range(2, longest + 1):
        grams = count_grams(encoded, n, id_bits, min_count, bitmap, **slicing)
        bitmap = bitmap_of(grams, slicing.get("bitmap_bits", BITMAP_BITS)) if n < longest else None
        own = grams.select("lang", "ids", F.col("uses").alias("a"))
        candidates = own if candidates is None else candidates.unionByName(own)
        counts = counts.unionByName(grams.select("lang", F.col("ids").alias("part"), "uses"))

    left = written(_scored(_not_inside(candidates, inside_share), counts, scale), "phrases")
    # The words of each phrase; a word may be in very many.
    spelled = written(left.select("lang", "ids", F.posexplode("ids").alias("at", "id")), "phrase-spelling")
    hot = hot_keys(spelled.groupBy("lang", "id").count(), ["lang", "id"], "count", max(1, spelled.count()))
    texts = (
        skewed_join(spelled, words.select("lang", "id", "word"), ["lang", "id"], hot)
        .groupBy("lang", "ids")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("lang", "ids", F.array_join("words.word", " ").alias("phrase"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = left.join(texts, ["lang", "ids"]).withColumn("part", part).withColumn("rank", first).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.drop("rank", "part").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
