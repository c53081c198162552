"""Best-fit packing of token sequences by minimum bin slack.

Per bin, bitset subset-sum dynamic programming over the available lengths finds the fullest
feasible combination, which is then removed. Only lengths matter, so the search runs on the counts
of pieces per length (at most ``capacity`` numbers, whatever the corpus), and a combination is
removed as often as the counts allow before the next search. Pieces then take the places of
their length in order of a distributed numbering.
"""

from __future__ import annotations

import array
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import full_text, python_tasks, written

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Different words whose ids a worker keeps, twice (an old and a young half).
KNOWN_WORDS = 250_000
#: Bytes of text that are tokenized at once, about.
BATCH_BYTES = 6 << 20
#: Pieces of one length that are numbered together.
GROUP_PIECES = 50_000


def _values(array: pa.Array) -> list:
    """A column without nulls as a list, faster than one Arrow scalar at a time."""
    return array.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """Token ids of texts through the ids of their different words.

    For a tokenizer that drops white space and works on each word by itself (``word_bpe_49k``), the
    ids of a text are those of its words in a row, so a batch's words are tokenized once each. Texts
    that spell a special token are tokenized whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _tokenize(self, words: list[str]) -> None:
        """Put the words' ids into the young half. Words of letters only are tokenized in one go."""
        letters = [w for w in words if w.isalpha()]
        for start in range(0, len(letters), 2000):
            part = letters[start : start + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                self._one_by_one(part)
                continue
            data, places = ids.tobytes(), [0, *(cuts * 4).tolist()]
            self.young.update(zip(part, [data[a:b] for a, b in zip(places, places[1:])]))
        self._one_by_one([w for w in words if not w.isalpha()])

    def _one_by_one(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False)):
            self.young[w] = array.array("I", e.ids).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Make the words known, from the old half or by tokenizing them."""
        young, old = self.young, self.old
        new = [w for w in words if w not in young]
        young.update((w, old[w]) for w in new if w in old)
        self._tokenize([w for w in new if w not in old])

    def _bytes_of(self, words: list[str]) -> list[bytes]:
        if len(self.young) > KNOWN_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, words))
        at = [i for i, ids in enumerate(found) if ids is None]
        if at:
            # "word," is "word" and ","; a stem that ends in a letter does not run into its points. It counts
            # in lower case: a dotted capital I becomes a letter and a mark, which does run into them.
            split, plain = [], []
            for i in at:
                w = words[i]
                if w in old:
                    young[w] = old[w]
                elif w[-1:] in (".", ",") and (stem := w.rstrip(".,")).lower()[-1:].isalpha():
                    split.append((w, stem, w[len(stem) :]))
                else:
                    plain.append(w)
            self._learn([*{*plain, *(x for _, stem, tail in split for x in (stem, tail))}])
            for w, stem, tail in split:
                young[w] = young[stem] + young[tail]
            for i in at:
                found[i] = young[words[i]]
        return found

    def _bytes_by_stems(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """(ids, the place of each word's among them): words that end in a letter and points are told apart all
        at once, so their stems are looked up with the other words, once each."""
        pointed = pc.match_substring_regex(words, "[a-z][.,]+$")
        ends = words.filter(pointed)
        stems = pc.utf8_rtrim(ends, ".,")
        units = pa.concat_arrays([stems, words.filter(pc.invert(pointed))]).dictionary_encode()
        known = self._bytes_of(_values(units.dictionary))
        found = [known[i] for i in _values(units.indices)]
        tails = pc.utf8_slice_codeunits(ends, -1).dictionary_encode()
        points = self._bytes_of(_values(tails.dictionary))
        found[: len(stems)] = [ids + points[i] for ids, i in zip(found, _values(tails.indices))]
        # Several points are looked up as they are.
        many = pc.greater(pc.subtract(pc.binary_length(ends), pc.binary_length(stems)), 1).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(many).tolist():
            stem = stems[i].as_py()
            found[i] = known[units.indices[i].as_py()] + self._bytes_of([ends[i].as_py()[len(stem) :]])[0]
        pointed, place = pointed.to_numpy(zero_copy_only=False), np.zeros(len(words), np.int32)
        place[pointed] = np.arange(len(stems))
        place[~pointed] = np.arange(len(stems), len(words))
        return found, place

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, the number of ids of each text)."""
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
        if whole.any():
            return self._mixed(texts, whole)
        lists = pc.ascii_split_whitespace(texts)
        coded = pc.ascii_lower(lists.flatten()).dictionary_encode()
        found, place = self._bytes_by_stems(coded.dictionary)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        codes = place[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = sizes[codes]
        starts = (np.cumsum(sizes) - sizes)[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
        bounds = np.concatenate([[0], ends])
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        return ids, np.diff(bounds[words])

    def _mixed(self, texts: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, lengths = [], []
        for i in range(len(texts)):
            if whole[i]:
                ids = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                ids = self.encode(texts.slice(i, 1))[0]
            parts.append(ids)
            lengths.append(len(ids))
        return np.concatenate(parts), np.array(lengths, np.int64)


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's tokenizer of a file, with the words it already knows."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of some megabytes: the more text at once, the fewer times a word is looked up."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > BATCH_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _cut(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(public_tokenizers.path(tokenizer))
        for batch in _joined(batches):
            ids, lengths = encoder.encode(batch.column("text"))
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for i in range(batch.num_rows):
                own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(own), capacity)):
                    part = own[at : at + capacity]
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            columns = [
                batch.column("doc_id").take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination {length: times} of the available lengths that fits, long ones first."""
    lengths = sorted(counts)
    reach, states = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in lengths:
        states.append(reach)
        left, step = min(counts[length], capacity // length), 1
        while left:
            step = min(step, left)
            reach |= (reach << (step * length)) & mask
            left, step = left - step, step * 2
    rest, chosen = reach.bit_length() - 1, {}
    for length, before in zip(reversed(lengths), reversed(states)):
        # The most of this length that shorter ones can complete.
        for times in range(min(counts[length], rest // length), -1, -1):
            if before >> (rest - times * length) & 1:
                break
        if times:
            chosen[length] = times
            rest -= times * length
    return chosen


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Minimum bin slack over counts of lengths: [(combination, how many bins have it)].

    Each step uses up a length of its combination (to less than the combination needs), so the
    list stays short however many pieces there are.
    """
    left = {length: n for length, n in counts.items() if n}
    out = []
    while left:
        chosen = fullest(left, capacity)
        bins = min(left[length] // times for length, times in chosen.items())
        out.append((chosen, bins))
        for length, times in chosen.items():
            left[length] -= times * bins
            if not left[length]:
                del left[length]
    return out


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its text's ids and ``end_id``; it is cut into pieces of ``capacity`` only where it
    is longer. ``with_ids`` adds each piece's ids. ``tokenizer`` names a file whose words are
    tokenized each by itself.

    A null or empty text is ``end_id`` alone; rows that repeat are packed each for itself; an
    empty table gives no rows. Which of equally long pieces gets which place is arbitrary.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    schema = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG" + ", ids ARRAY<INT>" * with_ids
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), full_text(text_column).alias("text"))
    pieces = given.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), schema)
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")

    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, first_bin, used = [], 0, dict.fromkeys(counts, 0)
    for chosen, bins in bin_patterns(counts, capacity):
        offset = 0
        for length in sorted(chosen, reverse=True):
            places.append((length, used[length], used[length] + bins * chosen[length], chosen[length], first_bin, offset))
            used[length] += bins * chosen[length]
            offset += length * chosen[length]
        first_bin += bins
    columns = "length LONG, low LONG, high LONG, times INT, first_bin LONG, base INT"
    table = spark.createDataFrame(places, columns)  # bounded by the capacity, not by the corpus

    # Number the pieces of each length: in groups of bounded size, shifted by the groups before.
    groups = max(1, -(-sum(counts.values()) // GROUP_PIECES))
    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    sizes = grouped.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("group")) - F.col("n")
    shifts = sizes.select("length", "group", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("group", "length").orderBy("row")) - 1
    numbered = (
        grouped.withColumn("place", place)
        .join(shifts, ["group", "length"])
        .withColumn("number", F.col("place") + F.col("before"))
    )
    n, t = numbered.alias("n"), F.broadcast(table).alias("t")
    inside = (F.col("n.length") == F.col("t.length")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high"))
    slot = F.col("number") - F.col("low")
    out = n.join(t, inside).select(
        "doc_id", "piece", "start", "n.length", "ids_crc32",
        (F.col("first_bin") + F.floor(slot / F.col("times"))).alias("sequence_id"),
        (F.col("base") + (slot % F.col("times")) * F.col("n.length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
    return out
