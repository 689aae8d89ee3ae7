"""Benchmark items in documents, exact or edited (operator 8).

Four words in a row, or with gaps of one or two between, are a seed, for short items
also three: of an item's copies in which up to a third of the words were exchanged, hardly
any lacks all of them.  The seeds of the benchmark are looked for in every text.  Where one turns up,
the words around it that an item's copy could take are kept as a passage.  Every
seed joins the passages and items that hold it; alignment of the passage with the
item, word by word, then scores what they share.  Equal passages are aligned once.

Tasks get the seeds of one slice at a time, of bounded size, and return passages
only, so the texts are never shuffled, and a larger benchmark means more passes
over them, not more memory.  What several slices find in a text is put together
before anything is counted, so the slices leave no trace in the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.batches import pieces
from rollcall.llm.groups import sorted_groups
from rollcall.llm.shingles import mixed, runs, words
from rollcall.plans.staging import written

#: Words of a seed, and where they stand beside words in a row.
SEED_WORDS = 4
GAPPED = ((0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4), (0, 1, 3, 5), (0, 1, 4, 5))
#: Seeds of three words, of items that have fewer than ``SHORT`` words.
BRIEF, SHORT = ((0, 1, 2), (0, 1, 3), (0, 2, 3)), 16
#: Words that a seed reaches over at most.
SPAN = 6
#: Seeds that tasks hold at a time, at 16 bytes each.
SLICE = 1 << 20
#: What an item's copy scores for a shared word, an exchanged one, an added or missing one.
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Least score, as a share of the item's words.
THRESHOLD = 0.5
_PIECE_BYTES = 1 << 19


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best score of a local alignment (Smith-Waterman), and the passage's word after it."""
    width = len(passage)
    climb = -GAP * np.arange(1, width + 1)
    above, best, end = np.zeros(width + 1), 0.0, 0
    for word in item:
        row = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum.accumulate(np.maximum(row, 0) + climb) - climb  # words of the passage left out
        top = int(row.argmax()) if width else 0
        if width and row[top] > best:
            best, end = float(row[top]), top + 1
        above[1:] = row
    return best, end


def seeds_of(numbers: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, text, first word of every seed, and whether it has three words only; by text.

    A text of fewer than four words has one more seed, the whole of it.
    """
    found, text, at = runs(numbers, firsts, SEED_WORDS)
    parts = [(found, text, at, np.zeros(len(found), bool))]
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    left = firsts[1:][text] - np.arange(len(numbers))
    shares = [mixed(numbers + np.uint64(1000 + k)) for k in range(SEED_WORDS)]
    for kind, places in enumerate(GAPPED + BRIEF, 1):
        at = np.flatnonzero(left > places[-1])
        total = sum((share[at + place] for share, place in zip(shares, places)), np.uint64(kind))
        parts.append((mixed(total), text[at], at, np.full(len(at), places in BRIEF)))
    found, text, at, brief = (np.concatenate(columns) for columns in zip(*parts))
    order = np.argsort(text, kind="stable")
    return found[order], text[order], at[order], brief[order]


def _seeds(batches):
    """``(item, item_id, words, seeds)`` of the items that have words."""
    for piece in pieces(batches, "text", _PIECE_BYTES):
        numbers, _, _, firsts = words(piece.column("text").to_pylist())
        found, text, _, brief = seeds_of(numbers, firsts)
        own = ~brief | (np.diff(firsts)[text] < SHORT)
        found, text = found[own], text[own]
        bounds = np.searchsorted(text, np.arange(len(firsts)))
        lists = [
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(own.astype(np.int64)))
            for at, own in ((firsts, numbers), (bounds, found))
        ]
        yield pa.RecordBatch.from_arrays([piece.column("item"), piece.column("item_id"), *lists], names=["item", "item_id", "words", "seeds"])


def _passages(batches, seeds: np.ndarray, reach: np.ndarray):
    """``(doc_id, own1, own2, at, words, seeds)`` of the passages around seeds; ``seeds`` is sorted, ``reach`` in words."""
    for piece in pieces(batches, "text", _PIECE_BYTES):
        numbers, _, _, firsts = words(piece.column("text").to_pylist())
        found, text, at, _ = seeds_of(numbers, firsts)
        place = np.minimum(np.searchsorted(seeds, found), len(seeds) - 1)
        hit = np.flatnonzero(seeds[place] == found)
        if not len(hit):
            continue
        text, at, near = text[hit], at[hit], reach[place[hit]]
        low, high = np.maximum(at - near, firsts[text]), np.minimum(at + SPAN + near, firsts[text + 1])
        order = np.argsort(low, kind="stable")
        low, high, text, own = low[order], high[order], text[order], found[hit][order]
        furthest = np.maximum.accumulate(high)
        first = np.flatnonzero(np.concatenate([[True], low[1:] >= furthest[:-1]]))
        last = np.append(first[1:], len(low))
        rows = [
            (int(low[a] - firsts[text[a]]), numbers[low[a] : furthest[b - 1]].astype(np.int64), np.unique(own[a:b]).astype(np.int64))
            for a, b in zip(first, last)
        ]
        yield _batch([piece.column(c).take(pa.array(text[first])) for c in ("doc_id", "own1", "own2")], rows)


def _batch(keys: list[pa.Array], rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    types = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    lists = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays([*keys, *lists], names=["doc_id", "own1", "own2", "at", "words", "seeds"])


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column without nulls."""
    return np.split(column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())[:-1])


def _merged(batches):
    """The passages of a text that overlap as one, as if their seeds had been of one slice; sorted by text and ``at``."""
    for group in sorted_groups(batches, ["own1", "own2"]):
        low, words, seeds = group.column("at").to_numpy(), _lists(group.column("words")), _lists(group.column("seeds"))
        high = low + np.array([len(w) for w in words])
        furthest = np.maximum.accumulate(high)
        first = np.flatnonzero(np.concatenate([[True], low[1:] >= furthest[:-1]]))
        rows = []
        for a, b in zip(first, np.append(first[1:], len(low))):
            whole = np.empty(furthest[b - 1] - low[a], np.int64)
            for k in range(a, b):
                whole[low[k] - low[a] : high[k] - low[a]] = words[k]
            # sorted as unsigned numbers, like those of a single slice
            rows.append((int(low[a]), whole, np.unique(np.concatenate(seeds[a:b]).astype(np.uint64)).astype(np.int64)))
        yield _batch([group.column(c).take(pa.array(first)) for c in ("doc_id", "own1", "own2")], rows)


def _scored(batches, threshold: float):
    """``(twin1, twin2, item_id, n_seeds, score, end)`` of the pairs that reach the threshold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        kept, found = [], []
        for row, (item, passage) in enumerate(zip(*(_lists(batch.column(c)) for c in ("item_words", "words")))):
            # no score is above the number of the item's words that the passage has
            if np.isin(item, passage).sum() / len(item) >= threshold:
                score, end = alignment(item, passage)
                if score / len(item) >= threshold:
                    kept.append(row)
                    found.append((score / len(item), end))
        own = [batch.column(c).take(pa.array(kept, pa.int64())) for c in ("twin1", "twin2", "item_id", "n_seeds")]
        ends = [pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.int32())]
        yield pa.RecordBatch.from_arrays([*own, *ends], names=["twin1", "twin2", "item_id", "n_seeds", "score", "end"])


def leaked_items(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, n_seeds, end_word``: the items that documents hold.

    ``score`` is that of the best local alignment as a share of the item's words, at
    least ``threshold`` and at most 1, ``n_seeds`` the seeds shared there, ``end_word``
    the word of the document after it.  Words are what ASCII blanks part, A-Z
    lower-cased.  A pair of ids has one row, the best of any equal ids.  Null or empty
    texts hold nothing and are held nowhere; an item of one or two words is found only
    where it is a whole text.  Empty tables give an empty one.
    """
    spark = documents.sparkSession
    item = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_key).cast("bigint").alias("item_id"), F.col(item_text).cast("string").cast("binary").alias("text")
    )
    items = item.mapInArrow(_seeds, "item bigint, item_id bigint, words array<bigint>, seeds array<bigint>")
    items = written(items.filter(F.size("words") > 0).withColumnRenamed("words", "item_words"))
    # a copy may have half as many words again as the item
    reach = F.ceil(F.size("item_words") * 1.5)
    entries = items.select("item", F.explode(F.array_distinct("seeds")).alias("seed"), reach.alias("reach"))
    wanted = written(entries.groupBy("seed").agg(F.max("reach").alias("reach")))
    slices = -(-wanted.count() // SLICE)
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    own_text = ["own1", "own2"]
    rows = rows.filter("text is not null").select("*", *[F.xxhash64(F.lit(k), "doc_id", "text").alias(f"own{k}") for k in (1, 2)])
    fields = "doc_id bigint, own1 bigint, own2 bigint, at int, words array<bigint>, seeds array<bigint>"
    passages = spark.createDataFrame([], f"{fields}, slice int")
    for part in range(slices):
        own = wanted.filter(F.pmod(F.xxhash64("seed"), F.lit(slices)) == part).toArrow()  # about SLICE rows
        numbers = own.column("seed").to_numpy().astype(np.uint64)
        order = np.argsort(numbers)
        shared = spark.sparkContext.broadcast((numbers[order], own.column("reach").to_numpy()[order]))
        found = rows.mapInArrow(lambda b, shared=shared: _passages(b, *shared.value), fields)
        passages = passages.unionAll(found.withColumn("slice", F.lit(part)))
    if slices > 1:
        # rows of one id and text count once, so what meets here is of one text
        once = [F.first(c).alias(c) for c in ("doc_id", "words", "seeds")]
        passages = passages.groupBy(*own_text, "slice", "at").agg(*once).select(*[f.split()[0] for f in fields.split(", ")])
        passages = passages.repartition(*own_text).sortWithinPartitions(*own_text, "at").mapInArrow(_merged, fields)
    twins = [F.xxhash64(F.lit(k), "words", "seeds").alias(f"twin{k}") for k in (1, 2)]
    passages = written(passages.select("doc_id", "at", "words", "seeds", *twins))
    twin = ["twin1", "twin2"]
    texts = written(passages.groupBy(*twin).agg(F.first("words").alias("words"), F.first("seeds").alias("seeds")))

    held = texts.select(*twin, F.explode("seeds").alias("seed"))
    pairs = held.join(written(entries.select("seed", "item")), "seed").groupBy(*twin, "item").agg(F.count(F.lit(1)).alias("n_seeds"))
    both = pairs.join(items.drop("seeds"), "item").join(texts.drop("seeds"), twin)
    fields = "twin1 bigint, twin2 bigint, item_id bigint, n_seeds bigint, score double, end int"
    scored = written(both.mapInArrow(lambda b: _scored(b, threshold), fields))
    found = passages.select("doc_id", "at", *twin).join(scored, twin).withColumn("end_word", F.col("at") + F.col("end"))
    best = F.max(F.struct("score", "n_seeds", "end_word")).alias("best")
    found = found.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "best.score", "best.n_seeds", "best.end_word")


def op8_decontamination(spark, folder):
    documents, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return leaked_items(documents, benchmark)
