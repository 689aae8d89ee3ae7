"""Token counts of texts for a byte-level BPE vocabulary (operator 4).

Most pre-tokens of a text are vocabulary strings that the merges turn into one
token.  Which strings these are is proved once for a vocabulary, by merging each
of them alone; a pre-token among them counts one by a lookup, and only the rest
is merged.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import public_tokenizers
import regex
from pyspark.sql import DataFrame

from rollcall.llm.batches import map_texts
from rollcall.llm.byte_symbols import BYTE_SYMBOLS

#: Merged pre-tokens that a Python worker remembers; beyond it, it starts anew.
REMEMBERED = 200_000


class BytePairMerges:
    """The merges of a vocabulary file in the ``tokenizers`` format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.vocabulary = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)

    def merge(self, symbols: str) -> list[str]:
        """The tokens of one pre-token, given as byte symbols: lowest rank first, leftmost among equals."""
        parts = list(symbols)
        n = len(parts)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ranks = self.ranks
        heap = [(rank, i, parts[i], parts[i + 1]) for i in range(n - 1) if (rank := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i] if parts[i] == left else n
            if j >= n or parts[j] != right:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (rank, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (rank := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (rank, h, parts[h], parts[i]))
        return [p for p in parts if p]


def whole_tokens(merges: BytePairMerges) -> set[str]:
    """Texts that are one token alone: proved by merging every vocabulary string."""
    byte_of = {symbol: byte for byte, symbol in enumerate(BYTE_SYMBOLS)}
    proved = set()
    for string in merges.vocabulary:
        if all(c in byte_of for c in string) and merges.merge(string) == [string]:
            try:
                proved.add(bytes(byte_of[c] for c in string).decode())
            except UnicodeDecodeError:
                pass  # part of a character: no pre-token is that
    return proved


class _Counts(dict):
    """Tokens by pre-token; merges what it does not know."""

    def __init__(self, merges: BytePairMerges):
        super().__init__(dict.fromkeys(whole_tokens(merges), 1))
        self.merges, self.proved = merges, len(self)
        self.limit = self.proved + REMEMBERED

    def __missing__(self, piece: str) -> int:
        n = len(self.merges.merge("".join([BYTE_SYMBOLS[b] for b in piece.encode()])))
        if len(self) < self.limit and len(piece) < 200:
            self[piece] = n
        return n

    def trim(self) -> None:
        if len(self) >= self.limit:
            for piece in [p for p, _ in zip(reversed(self), range(REMEMBERED))]:
                del self[piece]


@lru_cache(maxsize=2)
def _counter(path: str):
    counts = _Counts(BytePairMerges(path))
    find = regex.compile(public_tokenizers.PATTERN).findall
    specials = counts.merges.specials
    cut = regex.compile("|".join(map(regex.escape, specials))).split if specials else (lambda text: [text])

    def count(text: str) -> int:
        parts = cut(text)
        return len(parts) - 1 + sum(sum(map(counts.__getitem__, find(part))) for part in parts)

    return counts, count


def count_tokens(
    documents: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", limit: int = 512
) -> DataFrame:
    """``keys``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row.

    A null or empty text has no bytes and no tokens; a null key, equal keys and
    equal rows are kept as they are; an empty table gives an empty one.  Added
    tokens inside a text count one each.  No text is cut, whatever its length.
    """

    def work(texts):
        counts, count = _counter(path)
        sizes, tokens = [], []
        for value in texts:
            value = value or ""
            sizes.append(len(value.encode()))
            tokens.append(count(value))
        counts.trim()
        return [sizes, tokens, [n > limit for n in tokens]]

    return map_texts(documents, keys, text, "n_bytes bigint, n_tokens bigint, over_limit boolean", work)


def op4_token_counts(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"))
