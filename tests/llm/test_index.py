"""The positional index against a plain search for every window."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemill.llm import positional_index
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(docs, items, window=10):
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    holders = defaultdict(set)
    for i, t in items:
        w = terms(t)
        if i is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                holders[tuple(w[k : k + window])].add(str(i))
    sizes = {len(x) for x in holders}
    out = Counter()
    for d, t in docs:
        w, hit, found = terms(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = holders.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out[d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


def rows_of(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def tables(spark, docs, items, place):
    extra = "row INT, shard INT, term STRING, `a.b` INT"
    spark.createDataFrame([(*r, 1, 2, "t", 3) for r in docs], f"doc_id LONG, text STRING, {extra}").repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(*r, 1, 2, "t", 3) for r in items], f"item_id LONG, text STRING, {extra}").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_index_on_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute_hits(docs, items)
    assert rows_of(QUERIES["op13_positional_index"](spark, FOLDER)) == expected
    assert any(hit for *_, hit in expected)


def odd(rng):
    base = [f"w{rng.randrange(30)}" for _ in range(60)]
    items = [(i, " ".join(base[i : i + 14])) for i in range(0, 40, 3)] + [(100, "ONE, two"), (101, "one"), (102, None), (103, "!?"), (None, "two one")]
    items += [(i, " ".join(base[:14])) for i in range(200, 240)] + [(2, items[0][1].upper()), (2, "an other text of item two")]
    docs = [(i, " ".join(rng.choice(base) for _ in range(20)) + " " + "-".join(base[i : i + 25]).title()) for i in range(30)]
    docs += [(100, None), (100, ""), (101, "Two. One; one two"), (None, "one"), (None, "x"), (102, "a a a é字 ONE" * 30_000), (103, " ".join(base[:14]))]
    docs += [(200 + i, " ".join(base[:14])) for i in range(30)] + [(300, "ba\x00ab one\x7ftwo"), (301, " ".join(base[2:11]))]
    docs += [(302, " ".join(base[:6])), (303, " ".join(base[6:14]))]  # a window over two documents is none
    return docs, items


@pytest.mark.parametrize("shard_bytes", [1, 2000, 8 << 20])
def test_odd_texts(spark, place, shard_bytes):
    docs, items = odd(random.Random(8))
    tables(spark, docs, items, place)
    read = lambda name: spark.read.parquet(f"{place}/{name}.parquet")
    got = positional_index.contaminated(read("documents"), read("benchmark"), shard_bytes=shard_bytes)
    assert rows_of(got) == brute_hits(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([(1, "a b"), (2, None)], [(1, "c")])])
def test_empty_tables(spark, place, docs, items):
    assert rows_of(QUERIES["op13_positional_index"](spark, tables(spark, docs, items, place))) == brute_hits(docs, items)


def test_one_item_spreads_over_many_windows(spark, place):
    rng = random.Random(2)
    text = " ".join(f"v{rng.randrange(9)}" for _ in range(400))
    docs = [(i, text[i * 7 : i * 7 + 300]) for i in range(60)]
    items = [(i % 3, text) for i in range(9)]
    assert rows_of(QUERIES["op13_positional_index"](spark, tables(spark, docs, items, place))) == brute_hits(docs, items)


def test_bounded_candidates(monkeypatch):
    rng = np.random.default_rng(1)
    words = rng.integers(0, 4, 3000)
    lists = [np.flatnonzero(words == t) for t in range(4)]
    phrases = [rng.integers(0, 4, n) for n in (1, 2, 3, 5, 5, 5)] + [np.array([1, -1])]
    expected = {(k, s) for k, p in enumerate(phrases) for s in range(len(words) - len(p) + 1) if (words[s : s + len(p)] == p).all()}
    for bound in (1, 100, 1 << 20):
        monkeypatch.setattr(positional_index, "CANDIDATES", bound)
        which, start = positional_index.phrase_starts(phrases, lists)
        assert set(zip(which.tolist(), start.tolist())) == expected and len(which) == len(expected)


def test_proximity(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "alpha x x x x x beta gamma"), (3, "gamma"), (4, "alpha beta gamma alpha")]
    given = spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(1)
    documents, postings = positional_index.build_index(given)
    phrases = spark.createDataFrame([(b"p", ["alpha", "beta", "gamma"]), (b"q", ["alpha", "nowhere"])], "phrase BINARY, terms ARRAY<STRING>")
    found = positional_index.proximity_matches(documents, postings, phrases, 3).join(documents, "row")
    got = {(r.doc_id, bytes(r.phrase), r.at) for r in found.collect()}
    # beta is the rarest term, and has the others within three words in documents 1 and 4.
    assert got == {(1, b"p", 3), (4, b"p", 1)}


def test_lists_are_packed_without_loss():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, m, n)) for m, n in ((2, 1), (200, 90), (1 << 14, 5), (1 << 31, 40), (1, 1), (1 << 20, 3000))]
    uses = np.array([len(x) for x in lists])
    blobs = positional_index.packed_lists(np.concatenate(lists), uses).to_pylist()
    got = positional_index.unpacked_lists(blobs)
    assert [x.tolist() for x in got] == [x.tolist() for x in lists]
    assert [x.tolist() for x in positional_index.unpacked_lists(blobs[1:3])] == [x.tolist() for x in lists[1:3]]
    assert positional_index.packed_lists(np.zeros(0, np.int64), np.zeros(0, np.int64)).to_pylist() == [] == positional_index.unpacked_lists([])
