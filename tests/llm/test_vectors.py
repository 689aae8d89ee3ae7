"""Near vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from rollcall.llm import embedding_dups
from rollcall.llm.embedding_dups import FUNCTIONS, TABLES, WIDTH, bucket_numbers, near_vectors


def links(rows, threshold=0.98):
    """Links and class of every vector by comparing all pairs of a label."""
    out = [[k] for k in range(len(rows))]
    sound = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for a in sound:
        for b in sound:
            if a != b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                    out[a].append(b)
    found = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            todo += [n for n in out[todo.pop()] if n not in seen and not seen.add(n)]
        ids = [rows[n][0] for n in seen if rows[n][0] is not None]
        least = min(ids) if ids else None
        found.append((rows[k][0], len(out[k]) - 1, least, rows[k][0] == least))
    return found


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(1)
    rows, number = [], 0
    for label in range(3):
        for _ in range(25):
            centre = draw.standard_normal(48)
            for _ in range(int(draw.integers(1, 9))):
                rows.append((number, (centre + draw.uniform(0, 0.2) * draw.standard_normal(48)).astype(np.float32).tolist(), label))
                number += 1
    return rows


def test_recall_and_no_false_link(spark, vectors):
    expected = links(vectors)
    found = {r.vec_id: r for r in near_vectors(spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int")).collect()}
    assert all(found[i].n_links <= n for i, n, _, _ in expected)
    total = sum(n for _, n, _, _ in expected)
    assert total > 400 and sum(r.n_links for r in found.values()) >= 0.97 * total


@pytest.mark.parametrize("chunk", [512, 6])
def test_one_wide_bucket_is_exact(spark, rows, vectors, chunk):
    """With one cell for all, the hashing drops nothing: what is left are the exact steps."""
    odd = [(900, [1.0, 0.0], 1), (901, [2.0, 0.0], 1), (901, [0.0, 1.0], 1), (901, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (905, None, 1)]
    odd += [(906, [0.0, 0.0], 1), (907, [float("nan"), 1.0], 1), (908, [1.0, None], 1), (909, [1.0, 0.0], None), (910, [], 1), (911, [-0.0, 1.0], 1)]
    table = spark.createDataFrame([(*row, "x") for row in vectors + odd], "vec_id bigint, embedding array<float>, label int, node string")
    found = near_vectors(table, tables=2, functions=2, width=1e9, chunk=chunk)
    expected = links(vectors + odd)
    assert rows(found.select("vec_id", "n_links")) == sorted(((i, n) for i, n, _, _ in expected), key=repr)
    sure = {i for i, _, _, _ in expected} - {901, None}
    kept = lambda some: sorted(r for r in some if r[0] in sure)
    assert kept(map(tuple, found.collect())) == kept(expected)
    assert {tuple(r)[2:] for r in found.filter("vec_id is null").collect()} == {(None, True)}


def test_pairs_at_the_threshold_meet():
    draw = np.random.default_rng(5)
    first, other = draw.standard_normal((2, 5000, 32))
    first /= np.linalg.norm(first, axis=1)[:, None]
    other -= (first * other).sum(1)[:, None] * first
    other /= np.linalg.norm(other, axis=1)[:, None]
    near = 0.98 * first + np.sqrt(1 - 0.98**2) * other
    own = TABLES, FUNCTIONS, WIDTH
    met = (bucket_numbers(first, *own) == bucket_numbers(near, *own)).any(1)
    assert (~met).sum() <= 3


def test_bucket_numbers_depend_on_the_vector_alone():
    draw = np.random.default_rng(3)
    units = draw.standard_normal((20, 8))
    all_at_once = embedding_dups.bucket_numbers(units, 4, 3, 0.5)
    assert (all_at_once == np.vstack([embedding_dups.bucket_numbers(u[None], 4, 3, 0.5) for u in units])).all()


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("chunk", [512, 2])
def test_doubles_of_any_size_and_labels_of_any_type(spark, rows, chunk):
    table = [(1, [1e300, 2e300], "a"), (2, [1e300, 2e300], "a"), (3, [1e-200, 2e-200], "a"), (4, [3e-320, 6e-320], "a"), (5, [1.0, 2.0], "b"), (6, [1.0, 2.0], "")]
    table += [(7, [1.0, 2.0], None), (8, [2.0, 4.0], "b"), (9, [1.0 + 1e-12, 2.0], "b"), (10, [-1e300, -2e300], "a")]
    frame = spark.createDataFrame(table, "vec_id bigint, embedding array<double>, label string")
    a, b = [(k, 3, 1, k == 1) for k in (1, 2, 3, 4)], [(k, 2, 5, k == 5) for k in (5, 8, 9)]
    expected = sorted([*a, *b, *[(k, 0, k, True) for k in (6, 7, 10)]], key=repr)
    assert rows(near_vectors(frame, chunk=chunk)) == expected
    dated = frame.selectExpr("vec_id", "embedding", "CASE label WHEN 'a' THEN DATE'2020-01-01' WHEN 'b' THEN DATE'2020-01-02' WHEN '' THEN DATE'1970-01-01' END AS label")
    assert rows(near_vectors(dated, chunk=chunk)) == expected
