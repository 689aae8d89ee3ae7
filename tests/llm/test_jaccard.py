"""The similarity join against all pairs of texts."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from rollcall.llm import jaccard_join
from rollcall.llm.components import connected_components
from rollcall.llm.groups import forest
from rollcall.llm.shingles import shingle_sets, words

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))
    return {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()


def classes(prose, percent, size):
    sets = [shingles(text, size) for _, text in prose]
    root, links = list(range(len(prose))), [0] * len(prose)

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(prose)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            low, high = sorted((top(a), top(b)))
            root[high] = low
    members = {}
    for k, (key, _) in enumerate(prose):
        members.setdefault(top(k), []).append(key)
    least = {k: min((m for m in own if m is not None), default=None) for k, own in members.items()}
    return sorted(((key, len(sets[k]), least[top(k)], links[k]) for k, (key, _) in enumerate(prose)), key=repr)


@pytest.mark.parametrize(("percent", "size", "chunk"), [(90, 3, 512), (80, 5, 7), (60, 2, 20), (100, 1, 512)])
def test_classes(documents, prose, rows, percent, size, chunk):
    found = jaccard_join.jaccard_classes(documents, percent, size, chunk)
    assert rows(found) == classes(prose, percent, size)


def test_chunks_by_shingles(documents, prose, rows, monkeypatch):
    """Few long texts make as many chunks as many short ones; a text alone may be larger than a chunk."""
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", 40)
    assert rows(jaccard_join.jaccard_classes(documents, 80, 5)) == classes(prose, 80, 5)


def test_empty_table(no_documents):
    assert jaccard_join.jaccard_classes(no_documents).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_linked_sets_share_a_prefix_entry(percent):
    """Any frequencies, any sets: partners have an entry in common."""
    draw = np.random.default_rng(percent)
    tokens = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for _ in range(600):
        count = draw.choice([1, 2, 3, 4, 9, 500], len(tokens))
        n = int(draw.integers(1, 120))
        a = draw.choice(len(tokens), n, replace=False)
        shared = int(draw.integers(max(1, n * percent // 100 - 1), n + 1))
        b = np.concatenate([draw.permutation(a)[:shared], draw.choice(np.setdiff1d(np.arange(len(tokens)), a), int(draw.integers(0, n - shared + 3)))])
        b = np.unique(b)
        if 100 * shared < percent * len(np.union1d(a, b)):
            continue
        count[np.intersect1d(a, b)] = np.maximum(count[np.intersect1d(a, b)], 2)
        entries = []
        for own in (a, b):
            often = own[count[own] > 1]
            often = often[np.lexsort((tokens[often].astype(np.int64), count[often]))]
            entries.append(set(jaccard_join.signatures(len(own), len(own) - len(often), count[often], tokens[often], percent).tolist()))
        assert entries[0] & entries[1]


def test_word_numbers_depend_on_the_bytes_alone():
    """Words of every length, with zero bytes as well, get different numbers, the same in any surroundings."""
    draw = random.Random(3)
    own = {"".join(draw.choice("ab\x00é") for _ in range(draw.randrange(1, 14))) for _ in range(4000)}
    own |= {"a" * n for n in range(1, 60)} | {"a" + "\x00" * n for n in range(1, 60)}
    texts = [" ".join(own), *own, "x " + "\t".join(reversed(list(own)))]
    numbers, _, _, firsts = words([t.encode() for t in texts])
    whole = numbers[firsts[0] : firsts[1]]
    assert len(np.unique(whole)) == len(own)
    assert numbers[firsts[1] : firsts[len(own) + 1]].tolist() == whole.tolist()
    assert numbers[firsts[len(own) + 1] + 1 :].tolist() == whole[::-1].tolist()


def test_words_are_found():
    numbers, starts, ends, firsts = words([b"A bc\tdef  g", None, b"", b"  ", "Äß bc".encode(), b"x" * 50 + b" bc"])
    assert np.diff(firsts).tolist() == [4, 0, 0, 0, 2, 2]
    assert numbers[1] == numbers[5] == numbers[7] and len(set(numbers.tolist())) == 6
    assert list(zip(starts.tolist(), ends.tolist()))[:4] == [(0, 1), (2, 4), (5, 8), (10, 11)]


def test_words_made_to_fool_running_sums(spark, rows):
    """A doubling pattern and its complement agree in any sum of powers modulo 2 ** 64; they are two words all the same."""
    pattern = "a"
    for _ in range(10):
        pattern += pattern.translate({97: "b", 98: "a"})
    other = pattern.translate({97: "b", 98: "a"})
    prose = [(1, f"x {pattern} y"), (2, f"x {other} y")]
    found = jaccard_join.jaccard_classes(spark.createDataFrame(prose, "doc_id bigint, text string"), 90, 3)
    assert rows(found) == [(1, 1, 1, 0), (2, 1, 2, 0)]


def test_sets_are_distinct_and_sorted():
    found, starts = shingle_sets([b"a b a b a b", b"a", None, b"A b a"], 3)
    assert starts.tolist() == [0, 2, 3, 3, 4]
    assert found[0] < found[1] and found[3] in found[:2]


def test_components(spark, rows):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)]
    edges += [(2000, k) for k in range(2001, 2100)] + [(7777, 7777), (None, 5), (8, None)]
    root = {}

    def top(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    assert rows(found) == sorted(((k, top(k)) for k in root), key=repr)


def test_forest():
    adjacent = np.zeros((6, 6), bool)
    for a, b in [(0, 4), (4, 5), (5, 1), (2, 3)]:
        adjacent[a, b] = adjacent[b, a] = True
    assert forest(adjacent).tolist() == [0, 0, 2, 2, 0, 0]
