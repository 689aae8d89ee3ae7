"""The importance draw against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from rollcall.llm.importance import _segment_of, features, highest_ranks, importance_draw


def runs(text, size):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, size + 1) for i in range(len(words) - n + 1)]


def expected(documents, target, percent, least, size, buckets, seed):
    number = lambda feature: zlib.crc32(feature.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [text for _, text in documents]), (t, target)):
        for text in texts:
            for feature in runs(text, size)[1]:
                counts[number(feature)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for place, (doc_id, text) in enumerate(documents):
        words, found = runs(text, size)
        weight = sum(gain[number(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, words])
    chosen = sorted((row for row in out if row[5] >= least), key=lambda row: (-row[3], row[0] is None, row[0]))
    for rank, row in enumerate(chosen[: len(chosen) * percent // 100], 1):
        row[4] = rank
    return [tuple(row[:5]) for row in out]


TARGET = ["the straße of words", None, "", "A1 b2 THE the tion", "ñu ñu"]


@pytest.mark.parametrize("percent, least, size, buckets", [(10, 20, 1, 10_000), (50, 1, 3, 97), (100, 0, 2, 1), (0, 20, 1, 10)])
def test_draw(spark, rows, prose, documents, percent, least, size, buckets):
    target = spark.createDataFrame([(text, 1) for text in TARGET], "text string, doc_id int")
    found = importance_draw(documents, target, percent, least, size, buckets, segment_rows=7, samples=60)
    by_key = lambda table: sorted(table, key=repr)
    wanted = expected(prose, TARGET, percent, least, size, buckets, 2024)
    # rows with one id and score may change places
    assert by_key(r[:4] for r in map(tuple, found.collect())) == by_key(r[:4] for r in wanted)
    assert by_key((r[4], r[3], r[0]) for r in rows(found) if r[4]) == by_key((r[4], r[3], r[0]) for r in wanted if r[4])


def test_features_of_a_long_text():
    text = "Wörter-und 12 Zahlen, " * 120_000
    found, words = features(text, 2, 1000)
    assert words == 480_000 and len(found) == 2 * words - 1
    count, plain = runs(text, 2)
    assert count == words and sorted(found) == sorted(zlib.crc32(f.encode()) % 1000 for f in plain)


@pytest.mark.parametrize("size", [1, 5000])
def test_ranks_of_ties(spark, size):
    """Two thirds of the rows share one score, many one id as well."""
    table = spark.range(3000).selectExpr("id AS number", "if(id % 3 = 0, id, 7) AS score", "if(id % 2 = 0, 5, id) AS place_id", "id % 11 AS size")
    ranked = highest_ranks(table.repartition(6), "size > 0", 1000, segment_rows=size, samples=50).collect()
    order = sorted((r for r in table.collect() if r["size"] > 0), key=lambda r: (-r["score"], r["place_id"], r["number"]))
    assert len(ranked) == 3000
    assert {r["number"]: r["rank"] for r in ranked if r["rank"]} == {r["number"]: n for n, r in enumerate(order[:1000], 1)}


def test_segments_by_bisection():
    draw = np.random.default_rng(2)
    keys = np.array(sorted(map(tuple, draw.integers(0, 4, (200, 3)))))
    for count in (0, 1, 2, 63, 64):
        splitters = keys[:: max(1, len(keys) // max(count, 1))][:count]
        found = _segment_of(*keys.T, splitters.reshape(-1, 3))
        assert found.tolist() == [sum(tuple(s) <= tuple(k) for s in splitters) for k in keys]


def test_empty_tables(spark, documents, no_documents):
    none = spark.createDataFrame([], "text string")
    assert importance_draw(no_documents, none).count() == 0
    assert importance_draw(no_documents, documents).count() == 0
    assert importance_draw(documents, none).count() == documents.count()
