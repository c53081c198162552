"""Collocations and their filters against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemill.llm import collocations, quotient_filter as qf
from tidemill.llm.queries import QUERIES
from tidemill.session import scratch_made

FOLDER = "/root/testdata/sf0.001"


def brute_phrases(docs, longest=4, least=30, share=80, top=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) of (lang, text)."""
    uses, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for k in range(1, longest + 1):
                uses[lang].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, f in uses.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for b, a in often.items():
            for k in range(2, len(b)):
                inside.update(b[i : i + k] for i in range(len(b) - k + 1) if 100 * a >= share * f[b[i : i + k]])
        rows = []
        for p, a in often.items():
            if p not in inside:
                score, k = min(((2_000_000 * a) // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_of_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("lang", "text").collect()]
    expected = brute_phrases(docs)
    assert rows_of(QUERIES["op12_collocations"](spark, FOLDER)) == expected and len(expected) > 20


def odd(rng):
    docs = []
    for i in range(150):
        lang = rng.choice(["en", "en", "en", "de", "", None, "und"])
        words = [rng.choice("aa bb Cc dd ee é 字 x\x00y \x1f,".split(" ")) for _ in range(rng.randrange(0, 40))]
        docs.append((lang, "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "!"]) for w in words)))
    docs += [("en", "New York city hall is open"), ("en", "in New York city hall")] * 12 + [("xx", None), ("xx", ""), ("xx", ".,!")]
    docs += [("fr", "un deux trois " * 20_000), ("fr", "un deux"), ("fr", "w " * 50)]
    return docs


SMALL = [
    {}, {"slice_keys": 4, "fan_bits": 2, "bitmap_bits": 10}, {"slice_keys": 1, "fan_bits": 1, "id_bits": 17},
    {"id_bits": 32, "slice_keys": 8, "fan_bits": 3}, {"shard_bytes": 200, "held_bytes": 500, "slice_keys": 16, "fan_bits": 1},
]


@pytest.mark.parametrize("settings", SMALL)
def test_odd_texts(spark, place, settings):
    docs = odd(random.Random(6))
    extra = "shard INT, word STRING, ids STRING, part INT, rank INT, `a.b` INT"
    full = [(*r, 1, "w", "i", 2, 3, 4) for r in docs]
    spark.createDataFrame(full, f"lang STRING, text STRING, {extra}").repartition(4).write.parquet(f"{place}/docs")
    got = collocations.collocations(spark.read.parquet(f"{place}/docs"), min_count=6, top=40, **settings)
    assert rows_of(got) == brute_phrases(docs, least=6, top=40)


@pytest.mark.parametrize("docs", [[], [("en", None)], [("en", "a b. c")], [(None, "rare words only, each of them once")]])
def test_no_phrases(spark, docs):
    assert collocations.collocations(spark.createDataFrame(docs, "lang STRING, text STRING")).count() == 0


@pytest.mark.parametrize("n, bits", [(2, 1), (3, 5), (4, 15), (4, 16), (4, 17), (3, 22), (3, 32), (4, 31), (4, 32)])
def test_filters_lose_nothing(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    ids = [rng.integers(0, min(1 << bits, 40), 3000) for _ in range(n)]
    for x in ids:
        x[7] = (1 << bits) - 1
    ids[0][0] = ids[-1][1] = (1 << bits) - 1
    expected = Counter(zip(*[x.tolist() for x in ids]))
    keys = qf.packed_grams(ids, bits)
    changed = qf.permuted(*keys, n * bits)
    same = qf.restored(*changed, n * bits)
    assert (same[0] == keys[0]).all() and (keys[1] is None or (same[1] == keys[1]).all())
    for prefix in (0, 1, 2):
        found = Counter()
        for number, data in qf.slices(*qf.counted(*changed), n * bits, prefix):
            top, low, counts = qf.merged([data, data, qf.pack(*qf.unpack(data, n * bits, prefix, number), n * bits, prefix)], n * bits, prefix, number)
            own = qf.unpacked_grams(*qf.restored(top, low, n * bits), n, bits)
            found.update(dict(zip(zip(*[x.tolist() for x in own]), counts.tolist())))
        assert found == {k: 3 * v for k, v in expected.items()}


def test_large_counters():
    top = np.arange(5, dtype=np.uint64)
    counts = np.array([1, 2, 256, 257, 1 << 40])
    assert (qf.unpack(qf.pack(top, None, counts, 20, 0), 20, 0, 0)[2] == counts).all()


def test_bitmap_has_every_place(spark):
    place = [0, 1, 32767, 32768, 40000, 65535, (1 << 17) - 1]
    bitmap = collocations.bitmap_of(spark.createDataFrame([(x,) for x in place], "bit LONG"), 17)
    assert np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).tolist() == place


def made(spark, label, seen):
    return [spark.read.parquet(p) for p in scratch_made()[seen:] if p.rpartition("/")[2].startswith(label)]


def test_rows_stay_short(spark):
    """A task's shards don't grow with what it reads: a row of all its tokens filled the executors' memory."""
    words = " ".join(f"w{(i * i) % 4001} common phrase" for i in range(4000))
    docs = spark.range(0, 160, 1, 1).select(F.lit("en").alias("lang"), F.lit(words).alias("text"))
    seen = len(scratch_made())
    rows = collocations.collocations(docs, top=3).select("phrase", "a", "n").collect()
    assert all(r["n"] == 160 * 12_000 and r["a"] > 0 for r in rows) and len(rows) == 3
    (encoded,) = made(spark, "phrase-tokens", seen)
    # 12 MB of text with 1.9 million words; a shard ends with the batch that fills it.
    assert encoded.agg(F.sum("n"), F.max("n")).first()[0] == 160 * 12_000
    assert encoded.agg(F.max("n")).first()[0] <= 900_000


def test_batches_stay_small(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 300_000).alias("t"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    found = [r["n"] for r in collocations._sent(rows.mapInArrow(sizes, "n LONG"), "sizes").collect()]
    assert sum(found) == 40, found
    assert max(found) <= 5 and spark.conf.get(key) == before


@pytest.mark.parametrize("sent", [1, 6, 10, 1000])
def test_filters_are_sent_in_parts(sent):
    found = [(i, bytes(n)) for i, n in enumerate([1, 5, 20, 3, 3, 3, 3, 10, 1])]
    batches = list(collocations._filters(7, "en", found, sent))
    assert [(r["slice"], r["filter"]) for b in batches for r in b.to_pylist()] == found
    assert all(b.num_rows == 1 or sum(map(len, b.column("filter").to_pylist())) <= sent for b in batches)
