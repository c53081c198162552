"""Quality rules, duplicates, mixing and packing of documents against plain versions."""

import random
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm import bin_slack, exact_dedup, line_quality, ngram_join, source_mix
from tidemill.llm.components import components
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark, rows, place):
    """Rows (doc_id, text, source) as a table of documents with columns of clashing names."""
    full = [(d, t, "en", s, len(t or "")) for d, t, s in rows]
    extra = {c: F.lit(1) for c in ("row", "digest", "content", "host", "band", "length", "size", "key", "keep_id")}
    spark.createDataFrame(full, SCHEMA).withColumns(extra).repartition(3).write.parquet(f"{place}/docs")
    return spark.read.parquet(f"{place}/docs")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def plain(documents):
    return [(r.doc_id, r.text, r.source) for r in documents.select("doc_id", "text", "source").collect()]


EDGES = [
    (1, "a b", "x"), (2, "a \n b", "x"), (3, None, None), (4, "", "x"), (None, "a b", "y"), (5, " a b", "y"),
    (5, "q", "y"), (5, "q", "y"), (6, " ", None), (7, "w " * 40000, "x"), (8, "ж 字 𝔘 x", ""),
]


def test_exact_dedup_edges(spark, place):
    got = exact_dedup.dedup_classes(table(spark, EDGES, place)).collect()
    assert len(got) == len(EDGES)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.keep_id, r.group_size, r.kept))
    assert by[1] == [(1, 3, True)] and by[2] == [(1, 3, False)] and by[None] == [(1, 3, False)]
    assert by[3] == [(3, 2, True)] and by[4] == [(3, 2, False)]
    assert sorted(by[5]) == [(5, 1, True), (5, 2, False), (5, 2, True)]


def test_exact_dedup_tells_colliding_contents_apart(spark, documents, plain):
    expected = brute.exact([(d, t) for d, t, _ in plain])
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    for digest in (exact_dedup.sha256, weak):
        got = exact_dedup.dedup_classes(documents, digest=digest, salts=3).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in got} == expected
        assert {r.doc_id for r in got if r.kept} == {k for k, _, _ in expected.values()}


def test_drop_copies_keeps_columns(spark, place):
    docs = table(spark, EDGES, place)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "5", "6", "7", "8"]


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.bands_for(threshold, 0.999, 256)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999


def near_copies(n, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append((i, " ".join(w), "s"))
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_ngram_join_counts_every_link(spark, place, block):
    rows = near_copies(90) + [(1000 + i, t, s) for i, (_, t, s) in enumerate(near_copies(4, 9))]
    rows += [(2000, rows[5][1], "s"), (2001, "one two", "s"), (2002, "one  two", "s"), (2003, None, None), (2004, "", "s")]
    got = ngram_join.ngram_join(table(spark, rows, place), block_rows=block).collect()
    expected = brute.jaccard_classes([(d, t) for d, t, _ in rows])
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == expected


def test_ngram_join_on_documents(spark, plain):
    got = QUERIES["op3_ngram_jaccard"](spark, FOLDER).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute.jaccard_classes([(d, t) for d, t, _ in plain])


def test_one_of_each_class_stays(spark, place):
    docs = table(spark, [*EDGES, *near_copies(3)[1:]], place)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[3] == ids[4] == ids[6] == 1 and ids[None] == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_line_facts(spark, plain):
    got = QUERIES["op7_line_quality"](spark, FOLDER).collect()
    facts = {d: brute.line_facts(t) for d, t, _ in plain}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == facts


BOILER = [
    (i, f"Cookies  ACCEPTED here\nown text number {i} " + " ".join(f"u{i}x{k}" for k in range(9 if i % 3 else 1)), "h")
    for i in range(40)
]
LINES = BOILER + [(100 + i, BOILER[3][1], "h") for i in range(30)] + [(200, "Cookies accepted here\n" + "a b c d e f g h i j", "k"), (201, None, None), (202, "x y " * 30, "")]


def test_line_verdicts(spark, place):
    docs = table(spark, LINES, place)
    got = line_quality.line_quality(docs, line_docs=5).collect()
    expected = brute.line_verdicts(LINES, 5)
    assert {r.doc_id: (r.base_failed, r.removed_words, r.kept) for r in got} == expected
    out = line_quality.cleaned(docs, line_docs=5)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert set(rows) == {d for d, (_, _, kept) in expected.items() if kept}
    assert rows[1].text == BOILER[1][1].split("\n")[1] and rows[1].n_chars == len(rows[1].text)
    assert rows[200].text == LINES[70][1]


def test_op7_verdicts_on_documents(spark, plain):
    got = QUERIES["op7_line_quality"](spark, FOLDER).collect()
    expected = brute.line_verdicts(plain, line_quality.LINE_DOCS)
    assert {r.doc_id: (r.base_failed, r.removed_words, r.kept) for r in got} == expected


def test_registered_limits_cut_lines_and_reject(spark):
    """At sf0.01 frequent lines go, and where they are over half of a text, with lines of its own beside, it goes too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    most = docs.where("doc_id % 9 = 0").withColumns({"doc_id": F.col("doc_id") + 10**6, "source": F.lit("mirror")})
    lines = "one line that many of this mirror have in common\nand an other one they have\nown "
    most = most.withColumn("text", F.concat(F.lit(lines), F.col("doc_id").cast("string"), F.lit(" a b c d e f g h i j k")))
    rows = docs.unionByName(most)
    got = line_quality.line_quality(rows).collect()
    expected = brute.line_verdicts([(r.doc_id, r.text, r.source) for r in rows.collect()], line_quality.LINE_DOCS)
    assert {r.doc_id: (r.base_failed, r.removed_words, r.kept) for r in got} == expected
    own = [r for r in got if r.doc_id < 10**6]
    assert sum(r.removed_words > 0 for r in own) > 50
    assert all(r.removed_words == 16 and not r.base_failed and not r.kept for r in got if r.doc_id >= 10**6)


def test_the_tree_decides_the_shards(spark, documents):
    """Another tree gives other shards of the same rows, with exact quotas of every source's blocks."""
    mixes = [source_mix.mix_sources(documents, shards=4, blocks_per_shard=16, tree_seed=s).collect() for s in (1, 2)]
    taken = [{(r.doc_id, r.time): r.shard for r in m if r.shard is not None} for m in mixes]
    assert taken[0].keys() == taken[1].keys() and taken[0] != taken[1]
    assert all(set(t.values()) == {0, 1, 2, 3} for t in taken)
    rows = QUERIES["op6_source_mix"](spark, FOLDER).collect()
    assert all(r.taken == r.size * len(r.shards) for r in rows) and any(len(r.shards) == 2 for r in rows)


def test_shards_are_written_shuffled(spark, place, documents):
    mix = source_mix.mix_sources(documents, shards=3, blocks_per_shard=4)
    source_mix.write_shards(spark, mix, f"{place}/out")
    back = spark.read.parquet(f"{place}/out")
    key = ("shard", "doc_id", "time", "place")
    assert Counter(map(tuple, back.select(*key).collect())) == Counter(map(tuple, mix.where("shard is not null").select(*key).collect()))
    for shard in range(3):
        places = [r.place for r in spark.read.parquet(f"{place}/out/shard={shard}").coalesce(1).select("place", F.input_file_name()).collect()]
        assert places == sorted(places) and len(places) > 10
    mixed = source_mix.mixed_documents(documents, shards=3, blocks_per_shard=4)
    shard_of = defaultdict(set)
    for r in back.collect():
        shard_of[r.doc_id].add(r.shard)
    parts = mixed.select("doc_id", F.spark_partition_id().alias("p")).collect()
    least = [max(min(shard_of[r.doc_id]) for r in parts if r.p == p) for p in sorted({r.p for r in parts})]
    assert least == sorted(least)


ODD_NAMES = ["a.b", "cut", "cut_", "shard", "place", "time", "text.x", "__cut", "__numbered_row", "back`tick", "Row", "n_docs"]


@pytest.mark.parametrize("operator", [
    exact_dedup.drop_copies, ngram_join.one_of_each, line_quality.cleaned, source_mix.mixed_documents,
    exact_dedup.dedup_classes, ngram_join.ngram_join, line_quality.line_quality, source_mix.mix_sources, bin_slack.pack,
])
def test_columns_of_any_name(spark, place, operator):
    rows = [(i, f"word {i % 7} of some text that is long enough to be kept here {i % 7}", "h") for i in range(20)]
    docs = table(spark, rows, place)
    docs = docs.drop("row").select("*", *[F.lit(0).alias(c) for c in ODD_NAMES])
    docs.write.parquet(f"{place}/odd")
    docs = spark.read.parquet(f"{place}/odd")
    got = operator(docs)
    if operator in (exact_dedup.drop_copies, ngram_join.one_of_each, line_quality.cleaned, source_mix.mixed_documents):
        assert got.columns == docs.columns
    n = got.count()
    assert n == 7 if operator is exact_dedup.drop_copies else n > 0


def test_mix_reaches_targets(spark, plain):
    got = QUERIES["op6_source_mix"](spark, FOLDER).collect()
    again = QUERIES["op6_source_mix"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    source = {d: s for d, _, s in plain}
    size = {d: len(brute.words(t)) for d, t, _ in plain}
    sizes = Counter()
    for d in size:
        sizes[source[d]] += size[d]
    expected = brute.targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(expected[s])
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert len(got) == len(plain)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= largest[s]


def test_mix_edges(spark, place):
    docs = table(spark, EDGES, place)
    rows = source_mix.mix_sources(docs, shards=3, blocks_per_shard=2).collect()
    sizes = Counter()
    for _, t, s in EDGES:
        sizes[s] += len(brute.words(t))
    expected = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
    assert {r.row for r in rows} == {r.row for r in rows if r.time in (None, 1)}
    assert source_mix.mixed_documents(docs).columns == docs.columns


def test_splitting_tree_keeps_quotas(spark):
    units = spark.createDataFrame([("a", 50), ("b", 7), ("c", 0), ("d", 1)], "host STRING, units INT")
    rows = source_mix.split_quotas(units, 5, 1).collect()
    given, shard = Counter(), Counter()
    for r in rows:
        given[r.host] += r.quota
        shard[r.shard] += r.quota
    assert given == {"a": 50, "b": 7, "d": 1} and max(shard.values()) - min(shard.values()) <= 2 and len(shard) == 5
    for host in "ab":
        at = 0
        for r in sorted((r for r in rows if r.host == host), key=lambda r: r.shard):
            assert r.first == at
            at += r.quota


def packed(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return bins


def test_packing_on_documents(spark, plain):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op8_bin_slack"](spark, FOLDER).collect()
    expected = {(d, *p) for d, t, _ in plain for p in brute.pieces(t, tokenizer)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected and len(got) == len(expected)
    bins = packed(got)
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) * 1.01 + 1


ODD = [
    (1, "It's don't WE'LL 'sun word., x!. .,., a,b ,", "s"), (2, "<|endoftext|> a <|startoftext|>b <|ENDOFTEXT|>", "s"),
    (3, None, "s"), (4, "İstanbul ǅ ﬁ é a b   ćd 12345 ٣٤ Å 한국 \x1f q", "s"), (5, "", "s"), (5, "", "s"),
    (None, "zq" * 3000, "s"), (6, "word " * 30000, None),
]


def test_packing_odd_texts(spark, place):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = bin_slack.pack(table(spark, ODD, place), with_ids=True).collect()
    expected = Counter((d, *p) for d, t, _ in ODD for p in brute.pieces(t, tokenizer))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert all(len(r.ids) == r.length for r in got)
    packed(got)


def odd_words(n, seed):
    """Words of letters that change their length in lower case, marks, points and several scripts."""
    rng = random.Random(seed)
    parts = "VALİ BELEDİYESİ İ I i\u0307 ſ ẞ ŉ ǰ ΐ Σ ς ﬁ ŀ Å Å é e\u0301 \u0345 ж 字 한 ١ ² 𝔘 ª 's n't a B ' - . , ., !".split(" ")
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) + rng.choice(["", ".", ",", "...", ".,"]) for _ in range(n)]


def test_ids_are_the_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), odd_words(30_000, 12)
    texts = [" ".join(words[i : i + 3]) for i in range(0, len(words), 3)] + ["VALİ.", "VALİ", "BELEDİYESİ, VALİ..."]
    ids, lengths = bin_slack.word_ids(path).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
    assert lengths.tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_words_with_points_share_their_stem():
    words = bin_slack.WordIds(public_tokenizers.path(bin_slack.TOKENIZER))
    texts = ["Abc, abc abc. abc,,. x1, 1, .. , é, größé.. İ, a.b, a-b. don't,", "", "abc," * 3, "ẞ. ñ,, ǅ."]
    ids, lengths = words.encode(pa.array(texts))
    whole = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in whole for i in w] and lengths.tolist() == [len(w) for w in whole]
    assert "abc" in words.young and "abc," not in words.young and "abc,,." not in words.young


def test_bins_have_least_slack():
    rng = random.Random(5)
    counts = Counter(rng.randrange(1, 101) for _ in range(3000))
    left, used = Counter(counts), Counter()
    for chosen, bins in bin_slack.bin_patterns(counts, 100):
        assert sum(k * v for k, v in chosen.items()) <= 100
        for k, v in chosen.items():
            used[k] += v * bins
    assert used == left
    assert bin_slack.fullest({60: 2, 50: 1, 30: 1, 7: 3}, 100) == {60: 1, 30: 1, 7: 1}
    assert bin_slack.fullest({60: 1, 50: 2, 39: 1}, 100) == {50: 2}


@pytest.mark.parametrize("operator", [
    exact_dedup.dedup_classes, exact_dedup.drop_copies, ngram_join.ngram_join, ngram_join.one_of_each,
    line_quality.line_quality, line_quality.cleaned, source_mix.mix_sources, source_mix.mixed_documents, bin_slack.pack,
])
def test_empty_table(spark, place, operator):
    assert operator(table(spark, [], place)).count() == 0
