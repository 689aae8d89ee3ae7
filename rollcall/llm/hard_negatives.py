"""Hard negatives from exact inner products in residue arithmetic (operator 13).

Single-precision matrix products are the quickest there are, but sums beyond 24 bits
lose their last places in them.  So the whole numbers are taken modulo several small
primes, chosen so that no sum of residue products leaves 24 bits; each prime has a
product of its own, and the Chinese remainder theorem puts the exact signed scores
together, as mixed-radix digits from the middle of zero.

Two rounds over all vectors, in blocks: the first selects each anchor's positives among
the rows of its label, the second, for each positive, the best rows of other labels
whose scores lie in the window under the positive's.  A block reports no more rows for an
anchor than the result has.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.score_blocks import BLOCK_BYTES, dealt, first_of, matrix, numbered_vectors, records, steps
from rollcall.plans.staging import written

#: Sums in single precision stay exact below this, with room for half a prime more.
_EXACT = (1 << 24) - (1 << 13)
#: Components whose residue products are added up in one go.
_WIDTH = 1024


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def residue_primes(bound: int, width: int) -> list[int]:
    """Odd primes, the largest that sums of ``width`` residue products allow, with which -bound to bound are told apart."""
    half = math.isqrt((_EXACT - 1) // max(1, min(width, _WIDTH)))
    # digits are multiplied with inverses too, so residues stay below 2 ** 12 even for the shortest vectors
    candidate, primes, product = min(2 * half + 1, 1 << 12), [], 1
    while product < 2 * bound + 1:
        if candidate < 3:
            raise ValueError(f"no primes left for scores up to {bound}")
        if _is_prime(candidate):
            primes.append(candidate)
            product *= candidate
        candidate -= 1
    return primes


def residues(numbers: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The numbers modulo each prime, from the middle of zero, in single precision."""
    return [((numbers + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def _centred(values: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers in single precision, below 24 bits, modulo a prime from the middle of zero."""
    values = values - np.rint(values * np.float32(1 / prime)) * np.float32(prime)
    values[values > prime // 2] -= prime
    values[values < -(prime // 2)] += prime
    return values


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, given as residues: exact signed longs."""
    digits: list[np.ndarray] = []
    for left, right, prime in zip(a, b, primes):
        product = _centred(left[:, :_WIDTH] @ right[:, :_WIDTH].T, prime)
        for at in range(_WIDTH, left.shape[1], _WIDTH):
            product = _centred(product + _centred(left[:, at : at + _WIDTH] @ right[:, at : at + _WIDTH].T, prime), prime)
        # what the digits so far leave over, divided by the primes so far
        for digit, earlier in zip(digits, primes):
            product = _centred(_centred(product - digit, prime) * np.float32(pow(earlier, -1, prime)), prime)
        digits.append(product)
    scores, weight = np.zeros(digits[0].shape, np.int64), 1
    for digit, prime in zip(digits, primes):
        scores += digit.astype(np.int64) * weight
        weight = (weight * prime + (1 << 63)) % (1 << 64) - (1 << 63)  # wraps as the sum does, which ends in range
    return scores


def _holder(primes: list[int]):
    def hold(rows: pa.RecordBatch):
        ids, numbers, labels = (rows.column(c).to_numpy() for c in ("id", "number", "label"))
        order = np.lexsort((numbers, ids, labels))
        vectors = matrix(rows.column("vector")).astype(np.int64)[order]
        return ids[order], numbers[order], labels[order], residues(vectors, primes)

    return hold


def _best(anchor: np.ndarray, scores: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """Places of the first ``size`` of each anchor, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, anchor))
    return order[first_of(anchor[order], size)] if len(order) else order


_POSITIVES = "number bigint, anchor_id bigint, label bigint, positive_id bigint, score bigint"


def _positives(held, rows: pa.RecordBatch, primes: list[int], size: int):
    """The best ``size`` other rows of the label of each anchor."""
    ids, numbers, labels, vectors = held
    of_label = rows.column("label").to_numpy()
    for label in np.unique(of_label):
        # of the block's rows, those of the label lie together
        first, last = np.searchsorted(labels, label, "left"), np.searchsorted(labels, label, "right")
        if first == last:
            continue
        own = rows.filter(pa.array(of_label == label))
        asked, own_ids, own_numbers = residues(matrix(own.column("vector")).astype(np.int64), primes), own.column("id").to_numpy(), own.column("number").to_numpy()
        there = [v[first:last] for v in vectors]
        for part in steps(len(own), last - first):
            scores = exact_scores([v[part] for v in asked], there, primes)
            others = own_numbers[part][:, None] != numbers[None, first:last]
            spare = max(0, scores.shape[1] - size - 1)
            least = np.partition(scores, spare, axis=1)[:, spare]
            row, place = np.nonzero((scores >= least[:, None]) & others)
            kept = _best(row, scores[row, place], ids[first:last][place], size)
            row, place = row[kept], place[kept]
            if len(row):
                yield records(
                    _POSITIVES, own_numbers[part][row], own_ids[part][row], np.full(len(row), label), ids[first:last][place], scores[row, place]
                )


_NEGATIVES = "number bigint, place bigint, anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"


def _negatives(held, rows: pa.RecordBatch, primes: list[int], size: int):
    """For each positive of each anchor the best ``size`` rows of other labels in its window."""
    ids, _, labels, vectors = held
    asked = residues(matrix(rows.column("vector")).astype(np.int64), primes)
    numbers, own_ids, of_label = (rows.column(c).to_numpy() for c in ("number", "id", "label"))
    firsts = np.concatenate([[0], np.cumsum(rows.column("positives").value_lengths().to_numpy())])
    entries = rows.column("positives").flatten()
    place, low, high, positive_ids = (pc.struct_field(entries, name).to_numpy() for name in ("place", "low", "score", "id"))
    for part in steps(len(numbers), len(ids)):
        scores = exact_scores([v[part] for v in asked], vectors, primes)
        own = range(part.start, part.stop)
        lowest = np.array([low[firsts[i] : firsts[i + 1]].min() for i in own])
        highest = np.array([high[firsts[i] : firsts[i + 1]].max() for i in own])
        inside = (scores >= lowest[:, None]) & (scores <= highest[:, None]) & (labels[None, :] != of_label[part][:, None])
        row, at = np.nonzero(inside)
        found = scores[row, at]
        order = np.lexsort((ids[at], -found, row))
        row, at, found = row[order], at[order], found[order]
        starts = np.searchsorted(row, np.arange(len(own) + 1))
        chosen = []
        for i, k in enumerate(own):
            falling = -found[starts[i] : starts[i + 1]]
            for entry in range(firsts[k], firsts[k + 1]):
                begin = int(np.searchsorted(falling, -high[entry], "left"))
                end = min(begin + size, int(np.searchsorted(falling, -low[entry], "right")))
                chosen += [(k, entry, starts[i] + n) for n in range(begin, end)]
        if chosen:
            k, entry, n = np.array(chosen).T
            yield records(_NEGATIVES, numbers[k], place[entry], own_ids[k], positive_ids[entry], ids[at[n]], high[entry], found[n])


def hard_negatives(
    vectors: DataFrame,
    anchors: str | Column,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``anchors`` holds.  Components become
    ``floor(scale * component)``, a row's score is its exact inner product with the
    anchor; higher scores come first, ties by smaller id.  An anchor's positives are its
    first other rows of its label, and each gets the first rows of other labels that
    score at most what it does, and at least ``percent`` hundredths of that; below zero
    nothing does but, for 100, equal scores.  With fewer, all are given.

    Rows with a null id, label or vector, or with null or non-finite components, take no
    part; labels are whole numbers.  Vectors of different length have no score.  Repeated
    rows, and other rows with the anchor's id, are rows like any other.  Columns of other
    names are not read.  An empty table gives an empty one; scores that might not fit a
    long raise ``ValueError``.
    """
    if min(positives, negatives) < 1 or not 0 <= percent <= 100:
        raise ValueError("positive numbers of rows and a percentage are needed")
    of_label = F.col(f"`{label}`") if isinstance(label, str) else label
    condition = F.expr(anchors) if isinstance(anchors, str) else anchors
    sound = vectors.filter(of_label.isNotNull())
    numbered = numbered_vectors(sound, key, vector, scale, label=of_label.cast("bigint"), anchor=F.coalesce(condition, F.lit(False)))
    candidates, asking = numbered.table.drop("anchor"), numbered.table.filter("anchor").drop("anchor")
    primes = residue_primes(numbered.bound, numbered.longest)
    blocks = numbered.blocks(len(primes), block_bytes)
    hold = _holder(primes)

    near = dealt(candidates, asking, blocks, hold, lambda h, r: _positives(h, r, primes, positives), _POSITIVES)
    best = Window.partitionBy("number").orderBy(F.desc("score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
    # from percent * score <= 100 * negative
    low = F.ceil(F.col("score").cast("decimal(38,0)") * percent / 100).cast("bigint")
    entry = F.struct(F.col("place").cast("bigint").alias("place"), "low", "score", F.col("positive_id").alias("id"))
    near = near.withColumn("low", low).filter("low <= score").groupBy("number").agg(F.collect_list(entry).alias("positives"))
    asking = asking.join(written(near), "number")

    far = dealt(candidates, asking, blocks, hold, lambda h, r: _negatives(h, r, primes, negatives), _NEGATIVES)
    best = Window.partitionBy("number", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, "vec_id % 100 = 0", label=noisy)


# All scores of the anchors, ranked twice.
OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
), positives AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM scores WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY r, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives p JOIN scores s USING (r)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
