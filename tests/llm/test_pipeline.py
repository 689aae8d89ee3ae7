"""Each stage of the pipeline against a brute-force version, on its own input."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import byte_bpe
from rollcall.plans.staging import written

from test_jaccard import classes, shingles
from test_leaks import best, seeds, split
from test_repeats import covered

FOLDER = "/root/testdata/sf0.01"
PLANTED = "Zu Beginn wird jede neue Karte zweimal geprüft, einmal am Tag und einmal bei Nacht, weil das Licht die Farben der Linien verändert und niemand später sagen soll, " * 3


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A part of the given tables, with rows of every odd kind, as Parquet."""
    folder = str(tmp_path_factory.mktemp("tables"))
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(220).collect()]
    odd = [(10_000 + k, text, lang, "odd", None) for k, (text, lang) in enumerate(
        [(None, "en"), ("", "en"), ("12 34 !?", "de"), (given[3][1], None), (given[3][1], "fr"), (given[4][1] + PLANTED, "en"), (PLANTED + given[5][1], "en"), (PLANTED, "de")]
    )]
    item = benchmark.orderBy("item_id").first().text
    odd += [(11_000, f"{given[6][1]} {item} {given[7][1]}", "en", "leak", 1), given[8], (None, given[9][1] + " and more of the same", "en", "x", 5)]
    spark.createDataFrame(given + odd, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4).write.parquet(
        f"{folder}/documents.parquet"
    )
    return folder


@pytest.fixture(scope="module")
def steps(spark, tables):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, tables))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.schema.simpleString() == docs.schema.simpleString()
        out[name] = [tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()]
        docs = after
    return out


def test_stages_are_the_five():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "byte-level BPE",
    ]


def test_language(steps):
    before, after = steps["language ID"]
    gone = Counter(before) - Counter(after)
    assert not Counter(after) - Counter(before)
    assert {r[0] for r in gone} >= {10_000, 10_001, 10_002}
    assert all(not r[1] or len(r[1]) < 12 for r in gone)


def test_near_duplicates(steps):
    before, after = steps["n-gram Jaccard join"]
    texts = [(r[0], r[1]) for r in before]
    kept = {k for k, n, least, _ in classes(texts, 80, 5) if k == least or n == 0}
    assert sorted(after, key=repr) == sorted({r for r in before if r[0] in kept}, key=repr)
    assert all(shingles(t, 5) for _, t in texts)


def test_repeats(steps):
    before, after = steps["suffix-array dedup"]
    expected = []
    for row, (data, gone) in zip(before, covered([r[1] for r in before], corpus_pipeline.REPEAT_BYTES)):
        kept, at = [], 0
        for char in row[1]:
            size = len(char.encode())
            if not gone[at : at + size].all():
                kept.append(char)
            at += size
        text = "".join(kept)
        if text.strip(" \t\n\x0b\f\r") or len(text) == len(row[1]):
            expected.append((row[0], text, row[2], row[3], len(text)))
    assert sorted(after, key=repr) == sorted(expected, key=repr)
    assert not any(PLANTED[:300] in r[1] for r in after)


def test_decontamination(steps, spark):
    before, after = steps["benchmark decontamination"]
    items = [split(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    runs = [seeds(w, True) for w in items]
    expected = []
    for row in before:
        words = split(row[1])
        own = seeds(words)
        if not any(own & run and best(item, words) >= 0.5 * len(item) for item, run in zip(items, runs)):
            expected.append(row)
    assert sorted(after, key=repr) == sorted(expected, key=repr)
    assert 11_000 in {r[0] for r in before} - {r[0] for r in after}


def test_tokens(steps):
    before, after = steps["byte-level BPE"]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for row in before:
        ids = library.encode_ordinary(row[1])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((row[0], len(ids), digest, hashlib.sha256(row[1].encode()).hexdigest()))
    assert sorted(after, key=repr) == sorted(expected, key=repr)


NAMES = "score n_removed _number number lang_pred ambiguous others found repeated row h1 _c0 n".split()


def test_columns_named_like_the_operators_own(spark, tables):
    """They come out of every stage as they went in, and so do rows of a table without ``n_chars``."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").drop("n_chars")
    wide = docs.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in NAMES])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, after = stage(spark, docs, tables).collect(), stage(spark, wide, tables)
        assert after.schema.simpleString() == wide.schema.simpleString()
        found = [r for r in after.collect()]
        assert sorted((tuple(r) for r in plain), key=repr) == sorted((tuple(r)[: len(docs.columns)] for r in found), key=repr)
        assert all(r[name] == (None if r["doc_id"] is None else f"{name} {r['doc_id']}") for r in found for name in NAMES)


def test_stages_of_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, tables)
        assert after.count() == 0
        if name != "byte-level BPE":
            assert after.schema.simpleString() == docs.schema.simpleString()


def test_run_is_the_stages_in_order(spark, tables, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables).collect()), key=repr) == sorted(steps["byte-level BPE"][1], key=repr)
    assert corpus_pipeline.ORACLE_SQL is None
