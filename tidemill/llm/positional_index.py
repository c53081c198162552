"""Benchmark passages in documents, found through a distributed positional inverted index.

The index is a table. Documents are gathered to shards of some megabytes as they are read; a shard
has one row per document (its place among the shard's words) and one row per different token with
the token's positions, all in one pass and without a shuffle.

Phrases are looked up from their rarest terms. A phrase of terms reaches the shards that have its
rarest term by the index's counts; there, the term's positions less its offset in the phrase are the
candidates, and the lists of the other terms, less their offsets, are intersected with them from the
shard's rarest to its most frequent. Only lists of phrase terms are read and shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_words import byte_classes, byte_words
from .common import full_text, hot_keys, python_tasks, skewed_join, written
from .joined import joined_digests

#: Words of a window; an item of fewer is one window.
WINDOW = 10
#: Bytes of text in a shard, about; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: Candidates that are held at once while lists are intersected.
CANDIDATES = 2 << 20
#: Parts that the phrases of one rarest term are dealt to.
SALTS = 8
#: Bytes that part words: all of ASCII but digits and letters.
BETWEEN = bytes(b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123))
#: The same for texts in which A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_KINDS = byte_classes(BETWEEN)
_INDEX = pa.schema(
    [("shard", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("begin", pa.int64()), ("n_words", pa.int64()),
     ("term", pa.string()), ("uses", pa.int64()), ("places", pa.binary())]
)
_INDEX_SQL = "shard LONG, row LONG, doc_id LONG, begin LONG, n_words LONG, term STRING, uses LONG, places BINARY"
#: Terms whose lists one row batch of the index holds.
TERMS_A_BATCH = 20_000


def packed_lists(places: np.ndarray, uses: np.ndarray) -> pa.Array:
    """Each list's rising places as steps of seven bits a byte, low bits first; the last byte of a step is under 128.

    ``places`` has the lists in a row, ``uses`` their lengths.
    """
    ends = np.cumsum(uses)
    steps = np.diff(places, prepend=0)
    steps[ends - uses] = places[ends - uses]
    size = np.ones(len(steps), np.int64)
    for k in range(1, 9):
        more = steps >> (7 * k) > 0
        if not more.any():
            break
        size += more
    upto = np.cumsum(size)
    begin = upto - size
    data = np.empty(int(upto[-1]) if len(upto) else 0, np.uint8)
    at = np.arange(len(steps))
    for k in range(int(size.max()) if len(size) else 0):
        at = at[size[at] > k]
        data[begin[at] + k] = (steps[at] >> (7 * k) & 127) | np.where(size[at] > k + 1, 128, 0)
    offsets = np.concatenate([[0], upto[ends - 1]]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(uses), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked_lists(lists: list[bytes]) -> list[np.ndarray]:
    """The places of lists packed by ``packed_lists``."""
    if not lists:
        return []
    data = np.frombuffer(b"".join(lists), np.uint8)
    last = np.flatnonzero(data < 128)
    begin = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begin, last + 1 - begin)
    steps = np.add.reduceat((data & 127).astype(np.int64) << (7 * place), begin)
    upto = np.searchsorted(last, np.cumsum([len(x) for x in lists]))
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[np.concatenate([[0], upto[:-1]])]
    return np.split(total - np.repeat(before, np.diff(upto, prepend=0)), upto[:-1])


def _index_shard(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index rows of one shard. Words of a document are numbered in a row, with a gap of one behind."""
    table = pa.Table.from_batches(batches).combine_chunks()
    texts = table.column("text").chunk(0) if table.num_rows else pa.array([], pa.string())
    words, owner, _ = byte_words(texts, _KINDS)
    counts = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(counts + 1) - (counts + 1)
    place = np.arange(len(words)) + owner  # a shard's words are under 2**32, since its bytes are under 2**31
    shard = table.column("row")[0].as_py()

    def rows(n, **columns):
        given = {"shard": pa.array(np.full(n, shard)), **columns}
        return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(n, f.type) for f in _INDEX], schema=_INDEX)

    yield rows(
        len(texts), row=table.column("row").chunk(0), doc_id=table.column("doc_id").chunk(0),
        begin=pa.array(begin), n_words=pa.array(counts),
    )
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    # Code and place sort as one number, faster than an order of the codes is found.
    place = np.sort(codes.astype(np.int64) << 32 | place) & 0xFFFFFFFF
    uses = np.bincount(codes, minlength=len(coded.dictionary))
    lists = packed_lists(place, uses)
    for a in range(0, len(uses), TERMS_A_BATCH):
        n = len(uses[a : a + TERMS_A_BATCH])
        yield rows(n, term=coded.dictionary.slice(a, n), uses=pa.array(uses[a : a + n]), places=lists.slice(a, n))


def _index(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                more = pc.sum(pc.binary_length(part.column("text"))).as_py()
                if held and size + more > shard_bytes:
                    yield from _index_shard(held)
                    held, size = [], 0
                held.append(part)
                size += more
        if held:
            yield from _index_shard(held)

    return run


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(documents, postings) of a positional inverted index, a table in the shared folder.

    Documents: shard, row (unique), doc_id, begin, n_words. Postings: shard, term, uses, places
    (packed). A document's words have the shard's places from ``begin`` on.
    A null text has no words; rows that repeat are documents each; an empty table gives no rows.
    """
    python_tasks(docs.sparkSession)
    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        full_text(text_column).alias("text"),
    )
    index = written(given.mapInArrow(_index(shard_bytes), _INDEX_SQL), "positional-index")
    return (
        index.where("term is null").select("shard", "row", "doc_id", "begin", "n_words"),
        index.where("term is not null").select("shard", "term", "uses", "places"),
    )


def terms_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def windows_of(
    items: DataFrame, window: int = WINDOW, id_column: str = "item_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((phrase, terms), (phrase, words), (words, item)): the different windows, the word sequences that have
    them, and the items that are these sequences; written.

    Phrases and sequences are named by the SHA-256 of their terms. Items without words have none.
    Null ids are dropped, since they name no item.
    """
    name = lambda terms: F.unhex(F.sha2(F.concat_ws(" ", terms), 256))
    named = written(
        items.where(F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("string").alias("item"), terms_of(full_text(text_column)).alias("terms"))
        .where("size(terms) > 0")
        .withColumn("words", name("terms")),
        "test-items",
    )
    texts = named.groupBy("words").agg(F.any_value("terms").alias("terms"))  # copies are cut once
    last = F.greatest(F.size("terms") - window, F.lit(0))
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("terms", i + 1, window))
    cut = written(texts.select("words", F.explode(each).alias("terms")).withColumn("phrase", name("terms")), "test-windows")
    phrases = written(cut.groupBy("phrase").agg(F.any_value("terms").alias("terms")), "test-phrases")
    return phrases, cut.select("phrase", "words").distinct(), named.select("words", "item").distinct()


def _wanted(postings: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((shard, phrase, terms), postings of phrase terms): each phrase at the shards that have its rarest term."""
    terms = phrases.select("phrase", F.posexplode("terms").alias("at", "term"))
    lists = written(postings.join(terms.select("term").distinct(), "term", "left_semi"), "phrase-postings")
    known = lists.groupBy("term").agg(F.sum("uses").alias("total"))
    uses = terms.groupBy("term").count()
    hot = hot_keys(uses, ["term"], "count", max(1, terms.count()))
    rarest = (
        skewed_join(terms, written(known, "term-counts"), ["term"], hot, "left")
        .groupBy("phrase")
        .agg(F.min(F.struct(F.coalesce("total", F.lit(0)).alias("total"), "at", "term")).alias("least"))
        .where("least.total > 0")
        .select("phrase", "least.term", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    )
    # A term may be in all shards and the rarest of many phrases: its phrases are dealt to salts.
    salted = lists.select("term", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    at = salted.join(written(rarest, "phrase-rarest"), ["term", "salt"]).select("shard", "phrase")
    return written(at.join(phrases, "phrase"), "phrase-shards"), lists


def phrase_starts(phrases: list[np.ndarray], lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of all places where a phrase stands, by intersecting offset-adjusted lists.

    ``phrases`` has the numbers of each phrase's terms in ``lists`` (-1: without a list), ``lists`` the
    rising places of each term.
    """
    sizes = np.array([len(x) for x in lists], np.int64)
    base = int(max((x[-1] for x in lists), default=0)) + 2
    flat = np.concatenate([x + i * base for i, x in enumerate(lists)]) if lists else np.zeros(0, np.int64)
    first = np.cumsum(sizes) - sizes
    lengths = np.array([len(x) for x in phrases], np.int64)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for n in np.unique(lengths):
        number = np.flatnonzero(lengths == n)
        terms = np.stack([phrases[i] for i in number])
        full = (terms >= 0).all(axis=1)
        number, terms = number[full], terms[full]
        offset = np.argsort(sizes[terms], axis=1, kind="stable")  # rarest first
        terms = np.take_along_axis(terms, offset, axis=1)
        several = sizes[terms[:, 0]] if len(terms) else np.zeros(0, np.int64)
        # So many phrases together that their candidates stay within the bound.
        part = (np.cumsum(several) - several) // CANDIDATES
        for k in np.unique(part):
            own = np.flatnonzero(part == k)
            count = several[own]
            which = np.repeat(own, count)
            step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            rare = terms[which, 0]
            start = flat[first[rare] + step] - rare * base - offset[which, 0]
            for j in range(1, n):
                place = start + offset[which, j]
                sought = place + terms[which, j] * base
                spot = np.minimum(np.searchsorted(flat, sought), len(flat) - 1)
                stays = (flat[spot] == sought) & (place >= 0) & (start >= 0)
                which, start = which[stays], start[stays]
            found.append((number[which], start))
    return tuple(np.concatenate(x) for x in zip(*found))


def near_places(own: np.ndarray, lists: list[np.ndarray], within: int) -> np.ndarray:
    """The places of the rarest of the terms ``own`` that have each of them at most ``within`` words away."""
    order = sorted(np.unique(own).tolist(), key=lambda t: len(lists[t]))
    place = lists[order[0]]
    for t in order[1:]:
        after = np.searchsorted(lists[t], place - within)
        place = place[(after < len(lists[t])) & (lists[t][np.minimum(after, len(lists[t]) - 1)] <= place + within)]
    return place


class _Shard:
    """One shard's lists of phrase terms, and its documents."""

    def __init__(self, lists: pa.Table, documents: pa.Table):
        self.names = lists.column("term").combine_chunks()
        self.lists = unpacked_lists(lists.column("places").to_pylist())
        order = np.argsort(documents.column("begin").to_numpy(), kind="stable")
        self.begin = documents.column("begin").to_numpy()[order]
        self.n_words = documents.column("n_words").to_numpy()[order]
        self.row = documents.column("row").to_numpy()[order]

    def terms(self, phrases: pa.Table) -> list[np.ndarray]:
        terms = phrases.column("terms").combine_chunks()
        number = pc.fill_null(pc.index_in(terms.flatten(), value_set=self.names), -1).to_numpy(zero_copy_only=False)
        return np.split(number.astype(np.int64), np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))[:-1])

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, side="right") - 1


_MATCH_SQL = "row LONG, n_hit LONG, phrases ARRAY<BINARY>"


def _match(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Per document of a shard with a phrase: words within phrases, and the different phrases."""
    schema = pa.schema([("row", pa.int64()), ("n_hit", pa.int64()), ("phrases", pa.list_(pa.binary()))])
    if not right.num_rows:
        return schema.empty_table()
    kinds = np.array(left.column("term").is_null())
    shard = _Shard(left.filter(pa.array(~kinds)), left.filter(pa.array(kinds)))
    terms = shard.terms(right)
    which, start = phrase_starts(terms, shard.lists)
    if not len(which):
        return schema.empty_table()
    covered = np.zeros(int(shard.begin[-1] + shard.n_words[-1]) + 1, np.int32)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + np.array([len(x) for x in terms])[which], -1)
    upto = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
    doc = shard.document(start)
    pairs = np.unique(np.stack([doc, which], 1), axis=0)
    docs, first = np.unique(pairs[:, 0], return_index=True)
    names = right.column("phrase").to_pylist()
    found = [sorted(names[w] for w in part) for part in np.split(pairs[:, 1], first[1:])]
    hits = upto[shard.begin[docs] + shard.n_words[docs]] - upto[shard.begin[docs]]
    return pa.table({"row": pa.array(shard.row[docs]), "n_hit": pa.array(hits), "phrases": pa.array(found, pa.list_(pa.binary()))}, schema)


def _near(within: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("row", pa.int64()), ("phrase", pa.binary()), ("at", pa.int64())])
        if not right.num_rows:
            return schema.empty_table()
        kinds = np.array(left.column("term").is_null())
        shard = _Shard(left.filter(pa.array(~kinds)), left.filter(pa.array(kinds)))
        out = []
        # Documents stand ``within`` further apart here, so that nothing is near across their border.
        wide = [x + shard.document(x) * within for x in shard.lists]
        for phrase, own in zip(right.column("phrase").to_pylist(), shard.terms(right)):
            if (own >= 0).all():
                out += [(phrase, int(p)) for p in near_places(own, wide, within)]
        if not out:
            return schema.empty_table()
        phrases, place = zip(*out)
        wide = np.array(place)
        doc = np.searchsorted(shard.begin + np.arange(len(shard.begin)) * within, wide, side="right") - 1
        return pa.table(
            {"row": pa.array(shard.row[doc]), "phrase": pa.array(phrases, pa.binary()), "at": pa.array(wide - doc * within - shard.begin[doc])},
            schema,
        )

    return run


def _at_shards(documents: DataFrame, lists: DataFrame, wanted: DataFrame, run, schema: str) -> DataFrame:
    """``run`` for each shard that a phrase goes to, on its lists and documents and on these phrases."""
    shards = wanted.select("shard").distinct()
    none = F.lit(None)
    own = lists.select("shard", "term", "places", *[none.cast("long").alias(c) for c in ("row", "begin", "n_words")])
    rows = documents.select("shard", none.cast("string").alias("term"), none.cast("binary").alias("places"), "row", "begin", "n_words")
    left = own.unionByName(rows).join(shards, "shard", "left_semi")
    return left.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(run, schema)


def phrase_matches(documents: DataFrame, postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(row, n_hit, phrases) of each document that has a phrase: how many of its words lie in phrases, and which.

    ``phrases`` has phrase (its name) and terms; a phrase stands where its terms stand in a row.
    """
    wanted, lists = _wanted(postings, phrases)
    return written(_at_shards(documents, lists, wanted, _match, _MATCH_SQL), "phrase-matches")


def proximity_matches(documents: DataFrame, postings: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(row, phrase, at): words of the phrase's rarest term (in that shard) that have each of its terms at most
    ``within`` words before or behind, in the same document; ``at`` counts the document's words from 0."""
    wanted, lists = _wanted(postings, phrases)
    return _at_shards(documents, lists, wanted, _near(within), "row LONG, phrase BINARY, at LONG")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, row.

    A window is ``window`` words of an item in a row, or all of a shorter item's words. n_hit counts
    the words inside any occurrence of a window, n_items the items with one; items_sha256 is of their
    ids, sorted as text, joined by commas (none: of the empty text).

    A null text has no words; documents that repeat have rows each, with a null id too; items of one
    id count once; an empty table of documents gives no rows.
    """
    documents, postings = build_index(docs, id_column, text_column, shard_bytes)
    phrases, holders, owners = windows_of(items, window, item_id, item_text)
    found = phrase_matches(documents, postings, phrases)
    # Documents with the same set of windows have the same items: each different set is looked up once.
    sets = found.withColumn("whole", F.unhex(F.sha2(F.array_join(F.transform("phrases", lambda x: F.hex(x)), ""), 256)))
    different = sets.groupBy("whole").agg(F.any_value("phrases").alias("phrases"))
    named = (
        different.select("whole", F.explode("phrases").alias("phrase"))
        .join(holders, "phrase")
        .select("whole", "words")
        .distinct()
        .join(owners, "words")
        .select("whole", F.col("item").alias("member"))
        .distinct()
    )
    named = written(named, "test-sets")
    numbers = named.groupBy("whole").agg(F.count(F.lit(1)).alias("n_items"))
    digests = written(numbers.join(joined_digests(named), "whole"), "test-digests")
    rows = sets.select("row", "n_hit", "whole")
    hot = hot_keys(rows.groupBy("whole").count(), ["whole"], "count", max(1, rows.count()))
    hits = skewed_join(rows, digests, ["whole"], hot)
    none = F.lit(0).cast("long")
    return documents.join(hits, "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        "row",
    )
