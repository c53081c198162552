"""The corpus pipeline, each stage against a plain version on what the stage before kept."""

from collections import Counter

import brute
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemill.llm import line_quality

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the documents and of each stage's result."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, out = docs.columns, [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        result = stage(spark, docs, FOLDER)
        assert i == 4 or result.columns == columns
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_quality_stage(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[0]]
    verdict = brute.line_verdicts(rows, line_quality.LINE_DOCS)
    assert {r.doc_id for r in stages[1]} == {d for d, (_, _, kept) in verdict.items() if kept}
    assert all(r.n_chars == len(r.text) for r in stages[1])


def test_exact_stage(stages):
    groups = brute.exact([(r.doc_id, r.text) for r in stages[1]])
    assert sorted(r.doc_id for r in stages[2]) == sorted({keep for keep, _, _ in groups.values()})


def test_near_stage(stages):
    classes = brute.jaccard_classes([(r.doc_id, r.text) for r in stages[2]])
    assert sorted(r.doc_id for r in stages[3]) == sorted({c for c, _ in classes.values()})
    assert len(stages[3]) < len(stages[2])


def test_mix_stage(stages):
    size = lambda r: len(brute.words(r.text))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in stages[3]:
        sizes[r.source] += size(r)
        largest[r.source] = max(largest[r.source], size(r))
    for r in stages[4]:
        taken[r.source] += size(r)
    expected = brute.targets(sizes)
    assert all(abs(taken[s] - expected[s]) <= largest[s] for s in sizes)
    assert max(Counter(r.doc_id for r in stages[4]).values()) <= 2
    known = {tuple(r) for r in stages[3]}
    assert all(tuple(r) in known for r in stages[4])


def test_packing_stage(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter((r.doc_id, *p) for r in stages[4] for p in brute.pieces(r.text, tokenizer))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in stages[5]) == expected
    used = Counter()
    for r in stages[5]:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= sum(used.values()) / 2048 * 1.02 + 1


def test_run_is_the_stages_in_a_row(spark, stages):
    got = entry_points.queries()["pipeline"](spark, FOLDER)
    kept = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert kept(got.collect()) == kept(stages[5])
