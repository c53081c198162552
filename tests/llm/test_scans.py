"""Operators whose scans are cut differently from job to job, as after an executor is lost."""

from collections import Counter

import brute
import pytest

from tidemill.llm import exact_dedup, extendible, ngram_join, source_mix

FOLDER = "/root/testdata/sf0.001"
SPLITS, COST = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"


@pytest.fixture
def documents(spark, place):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.repartitionByRange(7, "doc_id").write.parquet(f"{place}/docs")
    return spark.read.parquet(f"{place}/docs")


@pytest.fixture
def moving(spark, monkeypatch):
    """Once an operator has written a table, later scans are cut otherwise."""
    cost = spark.conf.get(COST)
    spark.conf.set(COST, "1k")
    spark.conf.set(SPLITS, "1")
    for module in (exact_dedup, ngram_join, source_mix, extendible):

        def write(df, label, f=module.written):
            out = f(df, label)
            spark.conf.set(SPLITS, "12")
            return out

        monkeypatch.setattr(module, "written", write)
    yield
    spark.conf.unset(SPLITS)
    spark.conf.set(COST, cost)


def test_one_of_each_text(moving, documents):
    rows = documents.collect()
    expected = {k for k, _, _ in brute.exact([(r.doc_id, r.text) for r in rows]).values()}
    kept = exact_dedup.drop_copies(documents).collect()
    assert Counter(kept) == Counter(r for r in rows if r.doc_id in expected)


def test_one_of_each_class(moving, documents):
    rows = documents.collect()
    classes = brute.jaccard_classes([(r.doc_id, r.text) for r in rows])
    got = ngram_join.ngram_join(documents).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes
    kept = ngram_join.one_of_each(documents).collect()
    assert Counter(kept) == Counter(r for r in rows if r.doc_id in {c for c, _ in classes.values()})


def test_mix_gives_the_rows_it_drew(moving, documents, monkeypatch):
    drawn, mix = [], source_mix.mix_sources

    def kept(docs, **settings):
        drawn.append(mix(docs, **settings).localCheckpoint())
        return drawn[0]

    monkeypatch.setattr(source_mix, "mix_sources", kept)
    got = source_mix.mixed_documents(documents)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in drawn[0].where("shard is not null").collect())


def test_shards_hold_their_documents(spark, place, moving, documents):
    docs = documents.unionByName(documents.limit(1).repartition(1)).unionByName(documents.where("doc_id % 50 = 3"))
    docs.repartition(5).write.parquet(f"{place}/again")
    docs = spark.read.parquet(f"{place}/again")
    sharded = extendible.shard(docs, shard_bytes=3000)
    expected = Counter((r.doc_id, r.bytes, r.shard) for r in sharded.collect())
    extendible.write_shards(docs, sharded, f"{place}/out")
    back = spark.read.option("basePath", f"{place}/out").schema("doc_id LONG, text STRING, shard STRING").parquet(f"{place}/out/shard=*")
    assert Counter((r.doc_id, len(r.text.encode()), r.shard or "") for r in back.collect()) == expected


def test_mix_does_not_depend_on_places(spark, place):
    rows = [(i // 3 if i % 4 else None, f"w{i // 3 % 40} " * (i // 3 % 7), "ab"[i // 3 % 2]) for i in range(240)]
    drawn = []
    for name, files in (("one", 1), ("more", 6)):
        docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
        docs.repartition(files, "source", "text").write.parquet(f"{place}/{name}")
        mix = source_mix.mix_sources(spark.read.parquet(f"{place}/{name}"), shards=3, blocks_per_shard=4)
        drawn.append(Counter(tuple(r) for r in mix.drop("row").collect()))
    assert drawn[0] == drawn[1]
