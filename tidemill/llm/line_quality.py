"""Quality rules by cross-document line frequency.

Lines are normalised and hashed, the distinct documents that hold a line are counted per host,
lines above the host's limit are removed, and documents with too little left are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, ROW, fresh, full_text, named, named_key, numbered, python_tasks, row_number, skewed_join, written
from .words import windows, words_of

MIN_WORDS = 10
#: Repeated words (see ``facts``) above this percentage fail a document.
MAX_REPEATED = 20
REPEAT_WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
#: A line is boilerplate when more than this many distinct documents of its host have it.
LINE_DOCS = 6
#: A document that loses more than this percentage of its words with such lines is depleted.
MOST_REMOVED = 50

_FACTS = pa.schema(
    [
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("lines", pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32())]))),
    ]
)
_FACTS_SQL = (
    "n_words LONG, word_chars LONG, n_symbols LONG, n_dup_lines LONG, n_repeat_words LONG, "
    "lines ARRAY<STRUCT<line: LONG, words: INT>>"
)


def line_hash(line: bytes) -> int:
    """Hash of a line that is in lower case, without outer space and with single spaces."""
    return xxhash.xxh3_64_intdigest(b" ".join(line.split())) - (1 << 63)


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def facts(texts: pa.Array) -> list[pa.Array]:
    """The columns of _FACTS for each text."""
    n = len(texts)
    words, owner = words_of(texts)
    n_words = np.bincount(owner, minlength=n)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)

    hashes, at = windows(codes, owner, REPEAT_WINDOW)
    keys = hashes + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words) + 1, np.int64)
    starts = at[counts[which] > 1]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + REPEAT_WINDOW, -1)
    repeated = (np.cumsum(covered)[:-1] > 0).astype(np.int64)

    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    line_owner = np.repeat(np.arange(n), per_text)
    line_words = pc.count_substring_regex(lines, r"[^\x20\x09-\x0D]+").to_numpy(zero_copy_only=False)
    real = line_words > 0
    coded = lines.filter(pa.array(real)).dictionary_encode()
    line_codes = coded.indices.to_numpy(zero_copy_only=False)
    real_owner, real_words = line_owner[real], line_words[real]
    different = np.unique(real_owner * (len(coded.dictionary) + 1) + line_codes) // (len(coded.dictionary) + 1)
    dup_lines = np.bincount(real_owner, minlength=n) - np.bincount(different, minlength=n)
    known = np.fromiter(
        (line_hash(x) for x in pc.utf8_lower(coded.dictionary).cast(pa.binary()).to_pylist()),
        np.int64,
        len(coded.dictionary),
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(real_owner, minlength=n))])
    rows = pa.StructArray.from_arrays(
        [pa.array(known[line_codes], pa.int64()), pa.array(real_words.astype(np.int32))], ["line", "words"]
    )
    return [
        pa.array(n_words, pa.int64()),
        pa.array(_per_text(lengths, owner, n)),
        pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()),
        pa.array(dup_lines, pa.int64()),
        pa.array(_per_text(repeated, owner, n)),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = facts(batch.column("text"))
        kept = [batch.column(k) for k in ("row", "doc_id", "host", "digest")]
        yield pa.RecordBatch.from_arrays([*kept, *columns], ["row", "doc_id", "host", "digest", *_FACTS.names])


def measured(docs: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """Facts and line hashes of each document, written to the shared folder."""
    python_tasks(docs.sparkSession)
    text = full_text(text_column)
    given = docs.select(
        row_number(docs).alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        named_key(host_column).alias("host"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    return written(given.mapInArrow(_measure, f"row LONG, doc_id LONG, host STRING, digest BINARY, {_FACTS_SQL}"), "line-facts")


def frequent_lines(rows: DataFrame, least: int) -> DataFrame:
    """(host, line, n_docs) of lines in over ``least`` distinct documents of their host; written.

    Exact copies of a document count once. Counting is pre-aggregated per (host, line, document),
    so a line or host of any frequency is spread over all tasks.
    """
    lines = rows.select("host", "digest", F.explode("lines.line").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("digest").alias("n_docs"))
    return written(counts.where(F.col("n_docs") > least), "frequent-lines")


def line_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    line_docs: int = LINE_DOCS,
    most_removed: int = MOST_REMOVED,
) -> DataFrame:
    """Each document's base facts, the words in its too frequent lines, and the verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    removed_words, removed_lines (their hashes), kept, row (its number if ``docs`` is ``numbered``, else
    its place in a scan). ``kept`` is false if the base rules fail, if fewer than ``min_words`` words
    are left without the host's frequent lines, or over ``most_removed`` percent of them go. A line is frequent in a host
    where over ``line_docs`` distinct documents have it, however large the host.

    A null text has no words and fails; a null host is a host of its own; rows that repeat each get
    a row, and copies of a text count as one document of their host. An empty table gives no rows.
    """
    rows = measured(docs, id_column, text_column, host_column)
    frequent = frequent_lines(rows, line_docs)
    lines = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    total = rows.select(F.sum(F.size("lines"))).first()[0] or 0
    hot = frequent.where(F.col("n_docs") * HOT_SHARE > total).select("host", "line")
    cut = (
        skewed_join(lines, frequent.select("host", "line"), ["host", "line"], hot)
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed_lines"))
    )
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated)
    removed = F.coalesce(F.col("removed_words"), F.lit(0).cast("long"))
    return (
        rows.drop("lines")
        .join(cut, "row", "left")
        .select(
            "doc_id",
            *_FACTS.names[:5],
            failed.alias("base_failed"),
            removed.alias("removed_words"),
            F.coalesce("removed_lines", F.array().cast("array<bigint>")).alias("removed_lines"),
            (~failed & (F.col("n_words") - removed >= min_words) & (removed * 100 <= F.col("n_words") * most_removed)).alias("kept"),
            "row",
        )
    )


def _without(text_at: int, cut_at: int):
    """Cut the lines that one column names out of the texts of another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cut in zip(batch.column(text_at).to_pylist(), batch.column(cut_at).to_pylist()):
                if text and cut:
                    gone = set(cut)
                    text = "\n".join(x for x in text.split("\n") if not x.strip(" \t\r\x0b\x0c") or _hash_of(x) not in gone)
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns)], batch.schema.names
            )

    return run


def _hash_of(line: str) -> int:
    return line_hash(pc.utf8_lower(pa.scalar(line)).as_py().encode())


def cleaned(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    length_column: str | None = "n_chars",
    **limits,
) -> DataFrame:
    """The documents kept, without their hosts' frequent lines, in the columns of ``docs``.

    A text that loses lines gets its new length in ``length_column`` where there is such a column.
    """
    own = numbered(docs)
    cut = fresh(docs.columns, "cut")
    judged = line_quality(own, id_column, text_column, host_column, **limits)
    kept = judged.where("kept").select(F.col("row").alias(ROW), F.col("removed_lines").alias(cut))
    # Under plain names, since the step in Python resolves them.
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    given = own.join(kept, ROW).select(*[named(c).alias(at[c]) for c in docs.columns], named(cut).alias("gone"))
    out = given.mapInArrow(_without(docs.columns.index(text_column), len(docs.columns)), given.schema)
    columns = []
    for c in docs.columns:
        own = F.col(at[c])
        if c == length_column:
            length = F.char_length(at[text_column]).cast(docs.schema[c].dataType)
            own = F.when(F.size("gone") > 0, length).otherwise(own)
        columns.append(own.alias(c))
    return out.select(*columns)
