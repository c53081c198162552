"""Links of near copies where a bucket is cut by bytes into blocks that hold few texts or none."""

import brute
import pytest

from tidemill.llm import ngram_join


@pytest.mark.parametrize("n", [2, 3])
def test_links_count_once_where_blocks_are_empty(spark, place, n):
    words = [f"w{i}" for i in range(200)]
    rows = [(100 * g + i, " ".join([f"g{g}x{w}" for w in words] + [f"z{i}"])) for g in range(6) for i in range(n)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING").write.parquet(f"{place}/docs")
    got = ngram_join.ngram_join(spark.read.parquet(f"{place}/docs"), block_bytes=500).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute.jaccard_classes(rows)
