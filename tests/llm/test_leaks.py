"""Benchmark items in documents against alignment of every pair."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rollcall.llm import decontamination
from rollcall.llm.decontamination import alignment, leaked_items

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))


def best(item, passage):
    above, top = [0.0] * (len(passage) + 1), 0.0
    for a in item:
        row = [0.0]
        for k, b in enumerate(passage):
            row.append(max(0.0, above[k] + (1 if a == b else -0.5), above[k + 1] - 0.5, row[k] - 0.5))
        top, above = max(top, *row), row
    return top


def seeds(words, of_item=False):
    """Four words in a row or with gaps, three for all but longer items; the whole of fewer than four words."""
    patterns = ((0, 1, 2, 3), *decontamination.GAPPED, *decontamination.BRIEF)
    patterns = patterns[:6] if of_item and len(words) >= decontamination.SHORT else patterns
    found = {(kind, *[words[k + place] for place in places]) for kind, places in enumerate(patterns) for k in range(len(words) - places[-1])}
    return found | ({tuple(words)} if 0 < len(words) < 4 else set())


@pytest.fixture(scope="module")
def tables():
    draw = random.Random(8)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("a", "e", "in", "ou", "and", "er", "st")] + ["the", "of"] * 6
    sentence = lambda n: [draw.choice(words) for _ in range(n)]
    items = [sentence(draw.randrange(8, 50)) for _ in range(12)]
    documents = [sentence(draw.randrange(200)) for _ in range(20)]
    for _ in range(40):
        own = list(draw.choice(items))
        for _ in range(draw.randrange(1 + len(own) // 3)):
            at = draw.randrange(len(own))
            own[at : at + draw.randrange(2)] = sentence(draw.randrange(2))
        documents.append(sentence(draw.randrange(60)) + own + sentence(draw.randrange(60)))
    documents += [items[0] * 3, items[1][:4] + sentence(30)]
    texts = lambda some: [(k, " ".join(own)) for k, own in enumerate(some)]
    return texts(documents) + [(900, None), (901, ""), (902, "Just three words"), (None, " ".join(items[2]))], texts(items) + [
        (50, None), (51, " "), (52, "just three words"), (53, " ".join(items[0]))
    ]


def test_alignment_score():
    draw = random.Random(1)
    for _ in range(200):
        item, passage = ([draw.randrange(6) for _ in range(draw.randrange(1, 12))] for _ in range(2))
        score, end = alignment(np.array(item), np.array(passage))
        assert score == best(item, passage)
        assert best(item, passage[:end]) == score


@pytest.mark.parametrize("slice_size", [1 << 20, 40])
def test_leaks(spark, tables, monkeypatch, slice_size):
    monkeypatch.setattr(decontamination, "SLICE", slice_size)
    documents, items = tables
    held = spark.createDataFrame([(*row, 5) for row in documents], "doc_id bigint, text string, item_id int")
    found = {(r.doc_id, r.item_id): r.score for r in leaked_items(held, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    for doc, text in documents:
        for item, wanted in items:
            words = split(wanted)
            score = best(words, split(text)) / len(words) if words else 0
            if score >= 0.5 and seeds(words, True) & seeds(split(text)):
                assert found.pop((doc, item)) == pytest.approx(score)
    assert not found


def test_frequent_single_seed(spark):
    """A leak that shares one seed is found however many documents hold it, as are copies of an item of one seed."""
    item = [f"w{k}" for k in range(15)]
    edited = [f"x{k}" if k in (4, 8, 12) else word for k, word in enumerate(item)]
    documents = [(k, " ".join([f"a{k}", *edited, f"b{k}", f"c{k} four words go round"])) for k in range(60)]
    documents += [(100 + k, " ".join(edited)) for k in range(60)]
    held = spark.createDataFrame(documents, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, "Four words go round"), (3, "w0 w1 w2 w3 " + "other " * 20)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.score, r.n_seeds, r.end_word) for r in leaked_items(held, items).collect()}
    shared = len(seeds(item, True) & seeds(edited))
    assert len({s for s in seeds(item, True) & seeds(edited) if s[0] == 0}) == 1
    expected = {(doc, 1): (0.7, shared, 16 if doc < 100 else 15) for doc, _ in documents} | {(doc, 2): (1.0, len(seeds(split("four words go round"), True)), 22) for doc in range(60)}
    assert found == expected


def test_slices_leave_no_trace(spark, tables, monkeypatch):
    """Seeds, scores and ends are the same whether the benchmark's seeds go out at once or in many slices."""
    documents, items = tables
    held = spark.createDataFrame(documents + documents[25:30], "doc_id bigint, text string")
    wanted = spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(map(tuple, leaked_items(held, wanted).collect()), key=repr)
    monkeypatch.setattr(decontamination, "SLICE", 40)
    assert max(n for _, _, _, n, _ in whole) > 10
    assert sorted(map(tuple, leaked_items(held, wanted).collect()), key=repr) == whole


@pytest.mark.parametrize("size", [8, 9, 10, 12, 15, 20, 30, 60])
def test_recall_against_alignment_of_all_pairs(size):
    """Copies with 15 to 30 in a hundred words exchanged, added or left out that reach the threshold have a seed."""
    draw, found, all_ = random.Random(size), 0, 0
    while all_ < 600:
        item, rate = [f"w{k}" for k in range(size)], draw.uniform(0.15, 0.3)
        copy = []
        for word in item:
            roll = draw.random()
            copy += [word] if roll > rate else [] if roll < 0.1 * rate else [word, "new"] if roll < 0.2 * rate else ["x"]
        if best(item, copy) >= 0.5 * size:
            all_ += 1
            found += bool(seeds(item, True) & seeds(copy))
    assert found >= 0.99 * all_


def test_seeds_of_texts():
    draw = random.Random(4)
    texts = [" ".join(f"w{draw.randrange(5)}" for _ in range(n)) for n in (0, 1, 3, 4, 5, 6, 40, 40)]
    numbers, _, _, firsts = decontamination.words([t.encode() for t in texts])
    found, text, at, brief = decontamination.seeds_of(numbers, firsts)
    own = [{int(s) for s in found[text == k]} for k in range(len(texts))]
    plain = [seeds(t.split()) for t in texts]
    assert [len(o) for o in own] == [len(p) for p in plain]
    assert all(len(own[a] & own[b]) == len(plain[a] & plain[b]) for a in range(8) for b in range(8))
    assert [int(brief[text == k].sum()) for k in range(4)] == [0, 0, 1, 2 + 1 + 1]
    assert (np.diff(text) >= 0).all() and (at >= firsts[text]).all()


def test_empty_tables(spark, tables, no_documents):
    documents, items = (spark.createDataFrame(t, f"{k} bigint, text string") for t, k in zip(tables, ("doc_id", "item_id")))
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert leaked_items(no_documents, items).count() == 0
    assert leaked_items(documents, none).count() == 0
