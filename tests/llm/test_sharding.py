"""Shards: exact sizes, every row once, a uniform law."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from rollcall.llm.sharding import communication_matrix, op6_sharding, shuffle_into_shards


def test_matrix_keeps_both_margins():
    draw = np.random.default_rng(1)
    for _ in range(50):
        targets = draw.integers(0, 30, 7).tolist()
        cuts = np.sort(draw.integers(0, sum(targets) + 1, 4))
        sources = np.diff([0, *cuts, sum(targets)]).tolist()
        matrix = communication_matrix(sources, targets, int(draw.integers(99)))
        assert matrix.sum(1).tolist() == sources and matrix.sum(0).tolist() == targets and (matrix >= 0).all()


@pytest.mark.parametrize(("shards", "block_rows"), [(40, 100_000), (3, 20), (7, 1), (300, 5)])
def test_every_row_once_in_exact_shards(documents, prose, shards, block_rows):
    clashing = documents.selectExpr("*", "1 as _row", "2 as _rank", "3 as shard", "4 as _own")
    found = shuffle_into_shards(clashing, shards, block_rows=block_rows).collect()
    assert {(r._row, r._rank, r._own) for r in found} == {(1, 2, 4)}
    assert Counter((r.doc_id, r.text) for r in found) == Counter(prose)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(shards)) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))


def test_shards_are_uniform(spark):
    """Row numbers meet shards and slots as in a uniform shuffle (chi-squared, fixed seeds)."""
    rows = spark.range(0, 4000, 1, 4)
    found = [r for seed in range(3) for r in shuffle_into_shards(rows, 8, seed=seed, block_rows=300).collect()]
    cells = Counter((r.id * 8 // 4000, r.shard) for r in found)
    assert sum((cells[a, b] - 187.5) ** 2 / 187.5 for a in range(8) for b in range(8)) < 100
    places = Counter((r.id * 8 // 4000, r.slot * 8 // 500) for r in found)
    assert sum((places[a, b] - 187.5) ** 2 / 187.5 for a in range(8) for b in range(8)) < 100


def test_query(spark):
    found = op6_sharding(spark, "/root/testdata/sf0.01")
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    rows = found.collect()
    encoded = {k: (text or "").encode() for k, text in texts.items()}
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        k: (len(data) + 16, zlib.crc32(data), "rows", None) for k, data in encoded.items()
    }
    assert sorted((r.shard, r.slot) for r in rows) == [(shard, slot) for shard in range(40) for slot in range(25)]


@pytest.mark.parametrize("count", [10, 10_000])
def test_the_steps_are_the_same_at_all_sizes(spark, count):
    plan = shuffle_into_shards(spark.range(count))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number") == 2 and plan.count("BroadcastHashJoin") == 1


def test_empty_table_and_bad_count(no_documents):
    assert shuffle_into_shards(no_documents).count() == 0
    with pytest.raises(ValueError):
        shuffle_into_shards(no_documents, 0)
