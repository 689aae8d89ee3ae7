"""Repeated byte strings of documents, by bounded suffix order (operator 1).

Every string of ``length`` bytes that occurs at two places is found, across all
texts.  So that equal strings meet in one task whatever their texts, each string is
sent where its *anchor* says: its substring of ``GRAM`` bytes with the least hash,
which equal strings share.  Neighbouring strings of a text mostly have one anchor,
so they travel together as one *stretch*.

1. Anchors are counted.  A stretch whose anchor occurs once holds no repeat; that
   settles most of a corpus with one small row for each stretch.
2. Equal stretches become one with a weight.  A weight above one makes all its
   strings repeats; an anchor with only one distinct stretch needs no more.
3. The distinct stretches of the other anchors are put in suffix order, a bounded
   number of bytes at a time, and threshold-bounded interval expansion over the
   Burrows-Wheeler transform tells which of their strings occur twice.
4. An anchor with very many distinct stretches (where one passage runs into
   thousands of different texts) would be a hot group.  It is split by the bytes next
   to it: its strings fall into classes by the anchor's place in them, those of a class
   share a stretch of bytes around the anchor that all of them hold, and these bytes
   are the anchor of the parts.  Parts go through steps 2 to 4 with classes half as wide,
   so after a few rounds a class has one place, where strings with one anchor are equal.

Every task's memory is bounded by its own rows; nothing is dropped on the way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.batches import pieces
from rollcall.llm.shingles import mixed
from rollcall.llm.suffixes import repeated_windows
from rollcall.plans.staging import discard, written

GRAM = 32
#: Distinct stretches of an anchor that are put in suffix order together, about as many as fill a chunk.
HOT = 1024
#: Bytes put in suffix order at a time, unless one anchor has more.
CHUNK_BYTES = 3 << 18
#: Bytes of stretches for each task; beyond so many tasks they are larger, and go through in chunks all the same.
TASK_BYTES, MOST_TASKS = 8 << 20, 1 << 16
_PIECE_BYTES = 1 << 19
_BLOCK = 1 << 19
_PLACE = np.uint64((1 << 21) - 1)
_BYTES = np.random.default_rng(20240608).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """A number for each substring of ``size`` bytes, from running sums of a polynomial; it only brings strings together."""
    powers = np.full(len(data), _BASE)
    powers[:1] = 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[data] * np.multiply.accumulate(powers))])
    inverse = np.full(len(data) + 1 - size, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    inverse[0] = 1
    return mixed((sums[size:] - sums[:-size]) * np.multiply.accumulate(inverse))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Stretches of the texts that ``offsets`` cuts out of ``data``.

    Their text, start in it, number of strings, anchor, and two hashes of their bytes.
    """
    gram = min(GRAM, length)
    parts: list[tuple[np.ndarray, ...]] = []
    for low in range(0, max(0, len(data) - length + 1), _BLOCK):
        own = data[low : low + _BLOCK + length - 1]
        grams = _grams(own, gram)
        # the first of equal grams counts, so equal strings have their anchor at the same place
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (_least(keys, length - gram + 1) & _PLACE).astype(np.int64)
        start = low + np.arange(len(place))
        text = np.searchsorted(offsets, start, "right") - 1
        inside = start + length <= offsets[text + 1]
        new = inside.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1] | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        if len(first):
            count = np.add.reduceat(inside.astype(np.int64), first)
            view, ends = memoryview(own), (first + count + length - 1).tolist()
            digests = b"".join(xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(first.tolist(), ends))
            contents = np.frombuffer(digests, np.uint64).reshape(-1, 2)
            parts.append((text[first], start[first] - offsets[text[first]], count, grams[place[first]], contents[:, 0], contents[:, 1]))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(columns) for columns in zip(*parts))


_STRETCH = "doc_id bigint, h1 bigint, h2 bigint, start int, count int, anchor bigint, c1 bigint, c2 bigint"


def _stretched(batches, length: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text", _PIECE_BYTES):
        texts = piece.column("text").to_pylist()
        offsets = np.concatenate([[0], np.cumsum([len(t or b"") for t in texts])])
        data = np.frombuffer(b"".join([t or b"" for t in texts]), np.uint8)
        text, start, count, anchor, c1, c2 = stretches(data, offsets, length)
        named = piece.select(["doc_id", "h1", "h2"]).take(pa.array(text))
        columns = [pa.array(start, pa.int32()), pa.array(count, pa.int32()), *(pa.array(x.astype(np.int64)) for x in (anchor, c1, c2))]
        yield pa.RecordBatch.from_arrays([*named.columns, *columns], names=[f.split()[0] for f in _STRETCH.split(", ")])


_CONTENT = "anchor bigint, c1 bigint, c2 bigint, weight bigint, hot boolean, content binary"


def _cut(batches, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that a text stands for."""
    names = [f.split()[0] for f in _CONTENT.split(", ")]
    for piece in pieces(batches, "text", _PIECE_BYTES):
        for text, wanted in zip(piece.column("text").to_pylist(), piece.column("wanted").to_pylist()):
            rows = [
                (w["anchor"], w["c1"], w["c2"], w["weight"], w["hot"], text[w["start"] : w["start"] + w["count"] + length - 1])
                for w in wanted
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                names=names,
            )


def _place(content: bytes, length: int) -> int:
    """Where the anchor of a stretch's strings begins in it."""
    grams = _grams(np.frombuffer(content[:length], np.uint8), min(GRAM, length))
    return int(np.argmin(grams & ~_PLACE))


def parts_of(content: bytes, place: int, length: int, width: int) -> Iterator[tuple[int, bytes, int, int]]:
    """Parts of a stretch whose anchor begins at ``place``: class, bytes around the anchor, first string, number of strings.

    A class holds the strings that have from ``k * width`` to ``(k + 1) * width - 1`` bytes
    before the anchor.  All of these hold ``k * width`` bytes before it, and behind it what
    is left to the string with the most bytes before it.
    """
    gram = min(GRAM, length)
    least, most = place - (len(content) - length), place
    for k in range(least // width, most // width + 1):
        behind = max(0, length - gram - (k + 1) * width + 1)
        low, high = max(least, k * width), min(most, (k + 1) * width - 1)
        yield k, content[place - k * width : place + gram + behind], place - high, high - low + 1


_ROOT = "r0 bigint, r1 bigint, r2 bigint, shift int"
_PART = f"anchor bigint, c1 bigint, c2 bigint, weight bigint, {_ROOT}, place int, content binary"
_PART_TYPES = (*[pa.int64()] * 7, pa.int32(), pa.int32(), pa.binary())


def _split(batches, length: int, width: int) -> Iterator[pa.RecordBatch]:
    """The parts of hot stretches; those of a stretch with copies name no root, since all its strings are known."""
    names = [f.split()[0] for f in _PART.split(", ")]
    for piece in pieces(batches, "content", _PIECE_BYTES):
        rows = []
        columns = [piece.column(c).to_pylist() for c in ("weight", "r0", "r1", "r2", "shift", "place", "content")]
        for weight, r0, r1, r2, shift, place, content in zip(*columns):
            place = _place(content, length) if place is None else place
            for k, around, first, count in parts_of(content, place, length, width):
                own = content[first : first + count + length - 1]
                anchor = xxhash.xxh3_64_intdigest(around, seed=width << 32 | k)
                named = np.array([anchor], np.uint64).view(np.int64).tolist() + np.frombuffer(xxhash.xxh3_128_digest(own), np.int64).tolist()
                root = (r0, r1, r2, shift + first) if weight == 1 else (None, None, None, None)
                rows.append((*named, weight, *root, place - first, own))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PART_TYPES)], names=names)


def _spans(repeated: np.ndarray) -> list[int]:
    """First and last-but-one index of every run of true values, in a row."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], repeated, [False]]).astype(np.int8)))
    return edges.tolist()


_FOUND = "anchor bigint, c1 bigint, c2 bigint, spans array<int>"


def _ordered(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Repeats in the stretches of whole anchors, some at a time; rows come sorted by anchor."""
    held: list[tuple] = []
    size = 0

    def flush():
        rows = []
        strings = [row[-1] for row in held]
        for (_, weight, *root, shift, _), repeated in zip(held, repeated_windows(strings, length)):
            if weight == 1 and repeated.any():
                rows.append((*root, [shift + k for k in _spans(repeated)]))
        held.clear()
        return rows

    def batch_of(rows):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["anchor", "c1", "c2", "spans"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "weight", "r0", "r1", "r2", "shift", "content")]
        for row in zip(*columns):
            if size >= CHUNK_BYTES and held[-1][0] != row[0]:
                if rows := flush():
                    yield batch_of(rows)
                size = 0
            held.append(row)
            size += len(row[-1]) + 1
    if held and (rows := flush()):
        yield batch_of(rows)


def _in_order(contents: DataFrame, length: int) -> DataFrame:
    """Repeats among the strings of each anchor that is not hot."""
    cool = contents.filter("not hot")
    size = cool.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    tasks = min(1 + size // TASK_BYTES, MOST_TASKS)
    return cool.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(lambda b: _ordered(b, length), _FOUND)


def _hot_repeats(contents: DataFrame, length: int) -> list[DataFrame]:
    """Repeats in the stretches of hot anchors, in rounds of parts with classes half as wide."""
    out = []
    width = 1 << (length - min(GRAM, length)).bit_length()
    part = ["anchor", "c1", "c2"]
    hot = contents.filter("hot")
    while width > 1 and not hot.isEmpty():
        width //= 2
        parts = written(hot.mapInArrow(lambda b, width=width: _split(b, length, width), _PART))
        root = F.min(F.struct("r0", "r1", "r2", "shift")).alias("root")
        distinct = parts.groupBy(*part).agg(F.sum("weight").alias("weight"), root, F.first("place").alias("place"), F.first("content").alias("content"))
        distinct = written(distinct.select(*part, "weight", "root.*", "place", "content"))
        variants = written(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1"))
        again = (F.col("variants") > HOT) & F.lit(width > 1)
        split, contents = contents, written(distinct.join(variants, "anchor").withColumn("hot", again).drop("variants"))
        discard(split)
        out.append(written(_in_order(contents, length)))
        copied = parts.filter("r0 is not null").join(distinct.filter("weight > 1").select(*part), part)
        ends = F.array(F.col("shift"), F.col("shift") + F.octet_length("content") - length + 1).alias("spans")
        out.append(written(copied.select(F.col("r0").alias("anchor"), F.col("r1").alias("c1"), F.col("r2").alias("c2"), ends)))
        discard(parts)
        discard(distinct)
        hot = contents.filter("hot")
    discard(contents)
    return out


def _keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    named = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashes = [F.xxhash64(F.lit(k), "text").alias(f"h{k}") for k in (1, 2)]
    return named.select("doc_id", *hashes, F.col("text").cast("binary").alias("text"))


def repeated_spans(documents: DataFrame, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(h1, h2, found)`` for every distinct text with repeats, ``h1, h2`` being hashes of it.

    ``found`` has ``(start, spans)`` for each stretch with repeats: ``spans`` are
    first and last-but-one places, from ``start``, where repeated strings begin.
    """
    keyed = _keyed(documents, key, text)
    long_enough = keyed.filter(F.octet_length("text") >= length)
    places = written(long_enough.mapInArrow(lambda b: _stretched(b, length), _STRETCH))
    seen = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    all_places, places = places, written(places.join(written(seen), "anchor"))
    discard(all_places)

    stretch = ["anchor", "c1", "c2"]
    owner = F.min(F.struct("h1", "h2", "doc_id", "start")).alias("owner")
    distinct = written(places.groupBy(*stretch).agg(F.count(F.lit(1)).alias("weight"), F.first("count").alias("count"), owner))
    variants = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
    compared = distinct.join(written(variants), "anchor").withColumn("hot", (F.col("variants") > HOT) & F.lit(length > GRAM))
    fields = F.struct(*stretch, "weight", "hot", "count", "owner.start").alias("wanted")
    compared = compared.select("owner.h1", "owner.h2", F.col("owner.doc_id").alias("own_id"), fields)
    wanted = compared.groupBy("h1", "h2", "own_id").agg(F.collect_list("wanted").alias("wanted"))
    wanted = wanted.alias("w")
    same = (F.col("d.h1") == F.col("w.h1")) & (F.col("d.h2") == F.col("w.h2")) & F.col("d.doc_id").eqNullSafe(F.col("w.own_id"))
    texts = long_enough.alias("d").join(wanted, same).select("d.text", "w.wanted")
    own = [F.col(c).alias(f"r{k}") for k, c in enumerate(stretch)]
    contents = texts.mapInArrow(lambda b: _cut(b, length), _CONTENT)
    contents = written(contents.select("*", *own, F.lit(0).alias("shift"), F.lit(None).cast("int").alias("place")))

    copied = distinct.filter("weight > 1").select(*stretch, F.array(F.lit(0), F.col("count")).alias("spans"))
    found = written(_in_order(contents, length).unionAll(copied))
    for more in _hot_repeats(contents, length):
        found = found.unionAll(more)
    own = F.collect_set(F.struct("start", "spans")).alias("found")
    return places.select("h1", "h2", "start", *stretch).join(found, stretch).groupBy("h1", "h2").agg(own)


def _covered(size: int, found: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes in repeated strings."""
    if not found:
        return []
    begins = [f["start"] + at for f in found for at in f["spans"][::2]]
    ends = [f["start"] + at - 1 + length for f in found for at in f["spans"][1::2]]
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, ends, -1)
    edges = _spans(np.cumsum(change[:-1]) > 0)
    return list(zip(edges[::2], edges[1::2]))


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the whole characters in the spans, and the bytes gone."""
    whole = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        whole.append((a, b))
    return _kept(data, whole).decode(), sum(b - a for a, b in whole)


def _with_found(documents: DataFrame, keyed: DataFrame, length: int, key: str, text: str) -> DataFrame:
    found = written(repeated_spans(documents, length, key, text))
    return keyed.join(found, ["h1", "h2"], "left")


def removal_digests(documents: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text`` for every row.

    Every byte in a string of ``length`` bytes that also starts anywhere else, in the
    same text or another, counts as removed; strings are judged on the texts as they
    came.  The digest is of the bytes that are left; ``text`` is what is left where a character
    goes only as a whole, null for a null text.  A null text counts as empty, a shorter text keeps all; equal rows repeat
    each other like any two texts.  An empty table gives an empty one.
    """
    keyed = _keyed(documents, key, text).select("doc_id", "h1", "h2", "text")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"

    def digested(batches):
        for piece in pieces(batches, "text"):
            rows = []
            for data, found in zip(piece.column("text").to_pylist(), piece.column("found").to_pylist()):
                left = None if data is None else _whole_characters(data, _covered(len(data), found, length))[0]
                data = data or b""
                spans = _covered(len(data), found, length)
                kept = _kept(data, spans)
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), left))
            n_bytes, n_removed, n_spans, digest, texts = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(digest), pa.array(texts, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    return _with_found(documents, keyed, length, key, text).mapInArrow(digested, schema)


def without_repeats(documents: DataFrame, length: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their text less the repeated strings, and ``n_removed``, the bytes gone.

    Only whole characters go.  Null texts stay null.  Other columns are as they were,
    except that ``n_removed`` replaces a column of that name.
    """
    others = [c for c in documents.columns if c not in ("n_removed", text)]
    hashes = [F.xxhash64(F.lit(k), F.col(text).cast("string")).alias(f"h{k}") for k in (1, 2)]
    packed = documents.select(F.struct(*[F.col(c) for c in others]).alias("others"), *hashes, F.col(text).cast("binary").alias("text"))
    packed = packed if others else packed.withColumn("others", F.lit(None).cast("struct<none:int>"))
    schema = f"others {packed.schema['others'].dataType.simpleString()}, text string, n_removed bigint"

    def cut(batches):
        for piece in pieces(batches, "text"):
            kept = []
            for data, found in zip(piece.column("text").to_pylist(), piece.column("found").to_pylist()):
                kept.append((None, 0) if data is None else _whole_characters(data, _covered(len(data), found, length)))
            texts, removed = map(list, zip(*kept))
            yield pa.RecordBatch.from_arrays(
                [piece.column("others"), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], names=["others", "text", "n_removed"]
            )

    done = _with_found(documents, packed, length, key, text).mapInArrow(cut, schema)
    columns = [F.col("text").alias(c) if c == text else F.col(f"others.{c}") for c in documents.columns if c != "n_removed"]
    return done.select(*columns, "n_removed")


def op1_suffix_dedup(spark, folder):
    return removal_digests(spark.read.parquet(f"{folder}/documents.parquet"), 400)


# Repeats among all windows of 400 bytes, two hexadecimal digits a byte.
OP1_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, coalesce(hex(encode(text)), '') AS h FROM documents
), windows AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS w
  FROM (SELECT r, h, unnest(generate_series(0, len(h) // 2 - 400)) AS i FROM d WHERE len(h) >= 800)
), starts AS (
  SELECT r, i FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)
), marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM starts
), numbered AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM marked
), runs AS (
  SELECT r, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, run
), whole AS (  -- c, d: the span without bytes of characters that reach out of it; these begin with 80 to BF
  SELECT r, a, b, a + CASE WHEN substr(h, 2 * a + 1, 1) NOT IN ('8', '9', 'A', 'B') THEN 0
      WHEN substr(h, 2 * a + 3, 1) NOT IN ('8', '9', 'A', 'B') THEN 1
      WHEN substr(h, 2 * a + 5, 1) NOT IN ('8', '9', 'A', 'B') THEN 2 ELSE 3 END AS c,
    b - CASE WHEN substr(h, 2 * b + 1, 1) NOT IN ('8', '9', 'A', 'B') THEN 0
      WHEN substr(h, 2 * b - 1, 1) NOT IN ('8', '9', 'A', 'B') THEN 1
      WHEN substr(h, 2 * b - 3, 1) NOT IN ('8', '9', 'A', 'B') THEN 2 ELSE 3 END AS d
  FROM runs JOIN d USING (r)
), parts AS (
  SELECT *, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before, lag(d, 1, 0) OVER (PARTITION BY r ORDER BY a) AS so_far FROM whole
), cut AS (
  SELECT d.r, sum(b - a) AS gone, count(*) AS spans,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept,
    string_agg(substr(h, 2 * so_far + 1, 2 * (c - so_far)), '' ORDER BY a) || substr(any_value(h), 2 * max(parts.d) + 1) AS left_over
  FROM parts JOIN d USING (r) GROUP BY d.r
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256,
  CASE WHEN left_over IS NULL THEN text ELSE decode(unhex(left_over)) END AS text
FROM d LEFT JOIN cut USING (r)
"""
