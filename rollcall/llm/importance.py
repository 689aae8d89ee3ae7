"""Documents drawn to look like a target, by importance weights (operator 12).

Word runs fall into buckets by their hash.  An array with one gain for each bucket, from
how often the target and the documents hold it, scores every document; random numbers
that depend on its id alone turn the scores into a draw without replacement, which then
is the documents with the highest ones.

These get exact ranks by parallel sorting with regular sampling: sorted runs, one for each
task, give samples at regular distances, the samples give splitters, each run goes to the
segments between splitters, segments are merged where they arrive, and the counts of the
segments before say where a segment's ranks begin.  The driver sees the bucket counts,
the samples and one count for each segment, all bounded by parameters.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.batches import map_texts, pieces
from rollcall.plans.staging import written

BUCKETS = 10_000
#: Least words of a document that can be drawn.
LEAST_WORDS = 20
SEED = 2024
#: Rows of a segment, on average.
SEGMENT_ROWS = 1 << 20
#: Most samples that choose the splitters.
MOST_SAMPLES = 1 << 18
#: Most segments, and so splitters.
MOST_SEGMENTS = 1 << 16
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_BLOCK = 1 << 20
_LAST = (1 << 63) - 1


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words in order, those of about ``_BLOCK`` bytes at a time."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + _BLOCK)
        end = gap.start() if gap else len(data)
        yield _WORD.findall(data, at, end)
        at = end


def features(text: str | None, size: int, buckets: int) -> tuple[np.ndarray, int]:
    """Buckets of all runs of up to ``size`` words of a text, and its number of words."""
    hashes, running, n_words = array("I"), [], 0
    # beyond ASCII, every byte of a character is a word's
    for words in _words((text or "").encode().lower()):
        n_words += len(words)
        if size == 1:
            hashes.extend(map(zlib.crc32, words))
            continue
        for word in words:
            running = [zlib.crc32(word), *[zlib.crc32(b" " + word, before) for before in running[: size - 1]]]
            hashes.extend(running)
    return np.frombuffer(hashes, np.uint32).astype(np.int64) % buckets, n_words


def bucket_counts(texts: DataFrame, text: str = "text", size: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; tasks add up their own."""

    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for piece in pieces(batches, "text"):
            for value in piece.column("text").to_pylist():
                total += np.bincount(features(value, size, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a document's weight, in thousandths."""
    all_documents, all_target = float(documents.sum()) + len(documents), float(target.sum()) + len(target)
    ratio = lambda s, t: (float(t) + 1) * all_documents / ((float(s) + 1) * all_target)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def _drawn(key: str, seed: int) -> Column:
    """A Gumbel variate in thousandths that the id alone decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _segment_of(falling: np.ndarray, ids: np.ndarray, numbers: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """How many splitters come before each row, by bisection over three keys."""
    low, high = np.zeros(len(ids), np.int64), np.full(len(ids), len(splitters))
    for _ in range(len(splitters).bit_length()):
        open_ = low < high
        middle = np.minimum((low + high) // 2, len(splitters) - 1)
        a, b, c = splitters[middle].T
        before = (a < falling) | ((a == falling) & ((b < ids) | ((b == ids) & (c <= numbers))))
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return -batch.column("score").to_numpy(), batch.column("place_id").to_numpy(), batch.column("number").to_numpy()


def _splitters(runs: DataFrame, rows: int, segments: int, samples: int) -> np.ndarray:
    """Regular members of the sorted regular samples of sorted runs, as rows of keys."""
    stride = max(1, rows // samples)

    def sampled(batches):
        seen = 0
        for batch in batches:
            at = np.arange((stride - 1 - seen) % stride, batch.num_rows, stride)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    keys = "score bigint, place_id bigint, number bigint"
    found = runs.select(*[k.split()[0] for k in keys.split(", ")]).mapInArrow(sampled, keys).toArrow().combine_chunks()
    if not found.num_rows:
        return np.empty((0, 3), np.int64)
    falling, ids, numbers = _keys(found.to_batches()[0])
    order = np.lexsort((numbers, ids, falling))
    cuts = np.unique(np.arange(1, segments) * len(order) // segments)
    return np.stack([falling, ids, numbers], 1)[order[cuts]]


def highest_ranks(rows: DataFrame, eligible: str, drawn: int, segment_rows: int = SEGMENT_ROWS, samples: int = MOST_SAMPLES) -> DataFrame:
    """All ``rows`` with ``rank``: 1, 2, 3 … for the ``drawn`` eligible ones that come first, null for others.

    ``rows`` have ``score``, ``place_id`` and ``number``: higher scores come first, then
    smaller ids, then numbers, which are unique.  They are written in sorted runs.
    """
    order = [F.desc("score"), F.asc("place_id"), F.asc("number")]
    runs = written(rows.withColumn("eligible", F.expr(eligible)).sortWithinPartitions("eligible", *order))
    total = runs.filter("eligible").count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    segments = min(MOST_SEGMENTS, max(2 * cores, math.ceil(total / segment_rows)))
    splitters = _splitters(runs.filter("eligible"), total, segments, samples)
    columns = rows.columns

    def placed(batches):
        for batch in batches:
            own = _segment_of(*_keys(batch), splitters).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(own)], names=[*columns, "segment"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    segmented = written(runs.filter("eligible").select(*columns).mapInArrow(placed, f"{schema}, segment int"))
    counts = sorted((r["segment"], r["n"]) for r in segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, before = [], 0  # MOST_SEGMENTS rows at most
    for segment, n in counts:
        if before < drawn:
            starts.append((segment, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "segment int, start bigint")
    # only segments that hold one of the first ones are exchanged
    reached = segmented.join(F.broadcast(starts), "segment").repartitionById(segments, "segment")
    place = F.col("start") + F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    rank = F.when(place <= drawn, place)
    others = segmented.join(F.broadcast(starts), "segment", "left_anti").drop("segment")
    others = others.unionByName(runs.filter("not eligible").select(*columns))
    return reached.select(*columns, rank.alias("rank")).unionByName(others.withColumn("rank", F.lit(None).cast("bigint")))


def importance_draw(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = LEAST_WORDS,
    size: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    segment_rows: int = SEGMENT_ROWS,
    samples: int = MOST_SAMPLES,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every document.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased;
    features are runs of up to ``size`` words, repeats counted.  A feature weighs what
    its bucket gains: the logarithm of how much more usual it is in the target's texts, with
    one added to each bucket, in thousandths rounded down.  ``score`` adds a Gumbel variate from
    ``seed`` and id.  Of the documents with at least ``least_words`` words the
    ``percent`` hundredths with the highest scores have a rank, ties by smaller id.

    Null and empty texts have no features and weight 0.  Null ids count as an empty text in
    the variate and come last among ties; repeated rows are documents of their own.  Texts
    are read whole, columns of other names not at all.  Empty tables are allowed.
    """
    if not 0 <= percent <= 100 or min(size, buckets) < 1:
        raise ValueError("a percentage, and a positive size and number of buckets are needed")
    gain = gains(bucket_counts(documents, text, size, buckets), bucket_counts(target, "text", size, buckets))

    def weighed(texts):
        n_words, n_features, weight = [], [], []
        for value in texts:
            found, words = features(value, size, buckets)
            n_words.append(words)
            n_features.append(len(found))
            weight.append(int(gain[found].sum()))
        return n_words, n_features, weight

    named = documents.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = map_texts(named, ["doc_id"], "text", "n_words bigint, n_features bigint, weight bigint", weighed)
    rows = rows.select(
        "*",
        (F.col("weight") + _drawn("doc_id", seed)).alias("score"),
        F.coalesce("doc_id", F.lit(_LAST)).alias("place_id"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = written(rows)  # written, so that numbers and texts' weights are worked out once
    drawn = rows.filter(F.col("n_words") >= least_words).count() * percent // 100
    ranked = highest_ranks(rows, f"n_words >= {least_words}", drawn, segment_rows, samples)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op12_importance_draw(spark, folder):
    return importance_draw(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


# The hash of each different word is worked out byte by byte.
OP12_SQL = r"""
WITH crc(entries) AS (
  SELECT list_transform(range(256), lambda c: list_reduce(range(8),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c))
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, w FROM (SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM d)
), target AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), hashed AS (
  SELECT w, xor(list_reduce([CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) FOR i IN range(len(h) // 2)],
    lambda a, b: xor(a >> 8, entries[xor(a & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM (SELECT w FROM words UNION SELECT w FROM target)), crc
), counts AS (
  SELECT bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
  FROM (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (w) GROUP BY bucket)
  FULL JOIN (SELECT bucket, count(*) AS t FROM target JOIN hashed USING (w) GROUP BY bucket) USING (bucket)
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + 10000)
    / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
  FROM counts
), weights AS (
  SELECT r, count(*) AS n, sum(gain) AS weight FROM words JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= 10 * n // 100 THEN rank END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
