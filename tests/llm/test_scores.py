"""Exact top k and hard negatives against all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rollcall.llm import hard_negatives as hard
from rollcall.llm.hard_negatives import exact_scores, hard_negatives, residue_primes, residues
from rollcall.llm.top_k import exact_top_k

FIELDS = "vec_id bigint, embedding array<double>, label int, id string, number int, vector int, block int, score int"


def numbers_of(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def scored(rows, scale, wanted):
    """For every asking row its place, and ``(-score, id, place)`` of the others in order."""
    vectors = [None if row[0] is None else numbers_of(row[1], scale) for row in rows]
    for a, own in enumerate(vectors):
        if own is None or not wanted(rows[a][0]):
            continue
        others = [b for b, v in enumerate(vectors) if b != a and v is not None and len(v) == len(own)]
        yield a, sorted((-sum(x * y for x, y in zip(own, vectors[b])), rows[b][0], b) for b in others)


def top_k(rows, k, scale, every):
    return sorted(
        (rows[a][0], n + 1, i, -s) for a, others in scored(rows, scale, lambda i: i % every == 0) for n, (s, i, _) in enumerate(others[:k])
    )


def negatives(rows, scale, every, positives, size, percent):
    rows = [row for row in rows if row[2] is not None]
    out = []
    for a, others in scored(rows, scale, lambda i: i % every == 0):
        label = rows[a][2]
        for s, i, _ in [o for o in others if rows[o[2]][2] == label][:positives]:
            inside = [o for o in others if rows[o[2]][2] != label and percent * -s <= 100 * -o[0] <= 100 * -s]
            out += [(rows[a][0], i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(inside[:size])]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors():
    """Rows with ties, copies, few and odd values, and lengths of their own."""
    draw = np.random.default_rng(4)
    rows = [(n, (draw.standard_normal(12) * 0.4).tolist(), int(draw.integers(0, 4))) for n in range(160)]
    rows += [(n, draw.integers(-2, 3, 12).astype(float).tolist(), int(draw.integers(0, 3))) for n in range(160, 320)]
    copied = rows[40][1]
    rows += [(n, copied, n % 3) for n in range(320, 440)]
    rows += [rows[80], rows[80], (80, rows[81][1], 1), (460, [0.0] * 12, 2), (480, [-1.0] * 12, 1)]
    rows += [(None, copied, 1), (500, None, 1), (520, [float("nan")] * 12, 1), (540, [float("inf")] * 12, 1), (560, [1.0, None] * 6, 1)]
    rows += [(580, copied, None), (600, [], 1), (601, [], 2), (620, [1.0, 2.0], 1), (621, [2.0, 1.0], 2), (622, [2.0, 1.0], 1), (640, [3.0], 1)]
    return rows


def table_of(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2, 3, 4) for row in rows], FIELDS).repartition(5)


@pytest.mark.parametrize("scale, bins, k", [(256, 1024, 5), (256, 64, 3), (1, 8, 7), (10**6, 1024, 4), (10**8, 64, 2), (256, 1024, 1000)])
def test_top_k(spark, rows, vectors, scale, bins, k):
    found = exact_top_k(table_of(spark, vectors), "vec_id % 20 = 0", k, scale, bins=bins, block_bytes=1 << 12)
    assert rows(found) == sorted(top_k(vectors, k, scale, 20), key=repr)


def test_top_k_of_few_blocks(spark, rows, vectors, monkeypatch):
    monkeypatch.setattr("rollcall.llm.score_blocks.SCORES", 64)
    found = exact_top_k(table_of(spark, vectors), "vec_id % 20 = 0")
    assert rows(found) == sorted(top_k(vectors, 5, 256, 20), key=repr)


@pytest.mark.parametrize("scale, positives, size, percent", [(256, 5, 5, 80), (1, 2, 3, 0), (256, 40, 1, 100), (10**6, 3, 4, 95), (10**8, 3, 300, 10)])
def test_hard_negatives(spark, rows, vectors, scale, positives, size, percent):
    found = hard_negatives(table_of(spark, vectors), "vec_id % 20 = 0", positives, size, percent, scale, block_bytes=1 << 12)
    expected = negatives([r for r in vectors if r[0] is not None], scale, 20, positives, size, percent)
    assert expected and rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width, most", [(1, 2**31 - 1), (2, 3), (64, 200), (64, 2**27), (700, 2**26), (3000, 1 << 25)])
def test_residue_scores_are_exact(width, most):
    draw = np.random.default_rng(width)
    a, b = draw.integers(-most, most + 1, (2, 40, width))
    a[0], b[0] = most, most
    b[1] = -most
    bound = width * most * most
    primes = residue_primes(bound, width)
    assert math.prod(primes) > 2 * bound and min(width, hard._WIDTH) * (max(primes) // 2) ** 2 < hard._EXACT
    found = exact_scores(residues(a, primes), residues(b, primes), primes)
    assert found.tolist() == (a.astype(object) @ b.T.astype(object)).tolist()


def test_scores_beyond_a_long(spark):
    table = spark.createDataFrame([(0, [1e300], 1)], "vec_id bigint, embedding array<double>, label int")
    for call in (exact_top_k, hard_negatives):
        with pytest.raises(ValueError, match="do not fit"):
            call(table, "vec_id = 0")


def test_empty_tables_and_no_asking_rows(spark):
    table = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 2)], "vec_id bigint, embedding array<float>, label int")
    for call in (exact_top_k, hard_negatives):
        assert call(table.limit(0), "true").count() == 0
        assert call(table, "vec_id > 2").count() == 0
        assert call(table, "vec_id = nullif(vec_id, vec_id)").count() == 0
