"""Language of texts by error-correcting output codes (operator 10).

Every language has a codeword of bits.  A binary classifier for each bit, a sum
of weights over the byte n-grams of the lower-cased text, predicts whether the
language is one of those with that bit set.  Decoding takes the codeword with
the least loss, each bit weighted by how well its classifier knows that
language, and flags a text as ambiguous where the next codeword is close.

The classifiers come from n-gram counts of all training rows: tasks add up their
own rows, so what is shuffled and collected is one row for each language and
n-gram bucket, whatever the number of documents.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.batches import map_texts, pieces

#: N-grams fall into so many buckets by their hash.
BUCKETS = 1 << 14
SIZES = (2, 3)
UNDETERMINED = "und"
#: Most languages for which every split into two sides has a bit of its own.
EXHAUSTIVE = 5
#: N-grams of the text for which the classifiers' hit rates are worked out.
TYPICAL = 40
#: Loss by which the second codeword has to be worse, or the text is ambiguous.
MARGIN = 0.02
_PIECE_BYTES = 1 << 19
_LETTER = regex.compile(r"\p{L}").search


def codewords(n: int) -> np.ndarray:
    """Codewords of ``n`` languages, as rows of -1 and 1; the same for the same ``n``."""
    if n <= 1:
        return np.ones((n, 0))
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    draws = np.random.default_rng(n)
    tries = [draws.choice([-1.0, 1.0], size=(n, max(15, 5 * math.ceil(math.log2(n))))) for _ in range(50)]
    agreement = [np.max(code @ code.T - 1e9 * np.eye(n)) + 1e6 * np.any(np.abs(code.sum(0)) == n) for code in tries]
    return tries[int(np.argmin(agreement))]


def _buckets(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-grams at every byte, ``BUCKETS`` where one leaves its text; starts of the texts."""
    encoded = [f" {text.lower()} ".encode() for text in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])
    out = np.full((len(SIZES), len(data)), BUCKETS, np.int64)
    for row, size in enumerate(SIZES):
        gram = np.zeros(max(0, len(data) - size + 1), np.uint32)
        for k in range(size):
            gram = (gram << np.uint32(8)) | data[k : k + len(gram)]
        out[row, : len(gram)] = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
        for k in range(1, size):
            out[row, starts[1:] - k] = BUCKETS
    return out, starts[:-1]


def _counted(batches):
    """``(lang, bucket, n)`` of one task's rows."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for piece in pieces([batch], "text", _PIECE_BYTES):
            langs = np.array(piece.column("lang").to_pylist(), object)
            found, starts = _buckets(piece.column("text").to_pylist())
            ends = np.append(starts[1:], found.shape[1])
            for lang in set(langs):
                own = np.concatenate([found[:, a:b].ravel() for a, b, x in zip(starts, ends, langs) if x == lang])
                counts = np.bincount(own, minlength=BUCKETS + 1)[:BUCKETS]
                totals[lang] = totals.get(lang, 0) + counts
    for lang, counts in totals.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some], pa.int64())],
            names=["lang", "bucket", "n"],
        )


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` by bucket and bit, ``code`` by language and bit, ``trust`` likewise (rows add up to 1)."""

    languages: list[str]
    weights: np.ndarray
    code: np.ndarray
    trust: np.ndarray


def fit(counts: dict[str, np.ndarray]) -> LanguageModel:
    """The model from the bucket counts of each language; all languages weigh the same."""
    languages = sorted(counts)
    code = codewords(len(languages))
    if not code.shape[1]:
        return LanguageModel(languages, np.zeros((BUCKETS + 1, 0), np.float32), code, code)
    totals = np.array([counts[x] for x in languages], float)
    share = (totals + 0.5) / (totals.sum(1, keepdims=True) + 0.5 * BUCKETS)
    weights = np.empty((BUCKETS, code.shape[1]))
    for bit, side in enumerate(code.T):
        weights[:, bit] = np.log(share[side > 0].mean(0)) - np.log(share[side < 0].mean(0))
    mean = share @ weights
    spread = np.sqrt(np.maximum(share @ weights**2 - mean**2, 1e-12))
    hit = np.vectorize(lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2))))(code * mean / spread * math.sqrt(TYPICAL))
    return LanguageModel(
        languages, np.vstack([weights, np.zeros(code.shape[1])]).astype(np.float32), code, hit / hit.sum(1, keepdims=True)
    )


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fits the classifiers to every row that has a text and a language.

    Other rows are left out.  Without any such row the model knows no language.
    """
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    grouped = rows.mapInArrow(_counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for row in grouped.toLocalIterator():
        counts.setdefault(row.lang, np.zeros(BUCKETS))[row.bucket] = row.n
    return fit(counts)


def predict(model: LanguageModel, texts: Sequence[str | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and whether it is ambiguous, for each text."""
    readable = [bool(text and _LETTER(text)) and bool(model.languages) for text in texts]
    names, scores, unsure = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
    rows = [i for i, ok in enumerate(readable) if ok]
    if not rows:
        return names, scores, unsure
    found, starts = _buckets([texts[i] for i in rows])
    sums = sum(np.add.reduceat(model.weights[own], starts, axis=0) for own in found).astype(float)
    grams = np.diff(np.append(starts, found.shape[1])) * len(SIZES)
    margins = np.clip(sums / np.sqrt(grams + 10.0)[:, None], -30, 30)
    losses = np.einsum("dlb,lb->dl", np.log1p(np.exp(-margins[:, None, :] * model.code[None])), model.trust)
    near = np.exp(losses.min(1, keepdims=True) - losses)
    best, score = losses.argmin(1), 1 / near.sum(1)
    gap = np.sort(losses, axis=1)[:, 1] - losses.min(1) if losses.shape[1] > 1 else np.full(len(rows), np.inf)
    for i, b, s, g in zip(rows, best, score, gap):
        names[i], scores[i], unsure[i] = model.languages[b], float(s), bool(g < MARGIN)
    return names, scores, unsure


def identify(documents: DataFrame, model: LanguageModel, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for every row.

    A text that is null, empty or without a letter is ``und`` with score 0, and so
    is every text if the model knows no language.  Equal texts get equal answers;
    ties go to the language first in order.  Whole texts are read, however long.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(texts):
        out = [], [], []
        size, start = 0, 0
        for row, value in enumerate(texts):  # the weights of a byte take more room than the byte
            size += len(value or "")
            if size > _PIECE_BYTES // 2 or row == len(texts) - 1:
                for column, part in zip(out, predict(shared.value, texts[start : row + 1])):
                    column.extend(part)
                size, start = 0, row + 1
        return list(out)

    return map_texts(documents, keys, text, "lang_pred string, score double, ambiguous boolean", work)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document takes no part in training: its id's CRC-32 is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_language_id(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(documents.filter(~held_out()))
    found = identify(documents, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
