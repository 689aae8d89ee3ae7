"""Similarity join of documents on word shingles, by token combinations (operator 2).

Two texts link if their shingle sets have a Jaccard similarity of at least a
threshold.  A set of ``n`` shingles may miss ``m = floor((1 - threshold) n)`` of
them in a partner, so of any ``m + k`` of its shingles ``k`` are shared.

1. *Screen.*  Of each text the shingles with the lowest numbers, ``m`` and a
   tenth of the set more, are counted over all texts.  Where fewer than that tenth
   occurs in another text's as well, the text has no partner.
2. *Prefixes.*  The remaining texts' shingles are counted and ordered from rare to
   frequent.  A text with more than ``m`` unique shingles has no partner.  Of the
   others, a prefix is taken that loses something in common with every partner:
   single shingles where they are rare, combinations of two where they are frequent
   (those in one of a few cells, which makes the combinations few but takes a
   longer prefix).  Frequent shingles that unrelated texts share by chance thus
   bring nobody together.
3. *Verify.*  Texts tied by a common prefix entry form a family.  Families are cut
   into chunks, and every two chunks of a family are compared exactly by one task,
   which returns each text's number of links and a tie to its class; pairs are
   never written out.

Equal texts are one from the start and count as links of each other at the end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.batches import pieces
from rollcall.llm.components import connected_components
from rollcall.llm.groups import forest, sorted_groups
from rollcall.llm.shingles import mixed, shingle_sets
from rollcall.plans.staging import discard, written

#: Shingles in at most so many texts enter prefixes alone, others in combinations.
RARE = 3
#: Shared shingles that the screen asks for, as a fraction of the set.
SCREEN = 10
#: Texts of a family that one task compares with each other or with as many others, and shingles that these hold on average.
CHUNK, CHUNK_SHINGLES = 512, 1 << 21
_PIECE_BYTES = 1 << 20
_COLUMNS = 4096


def missing(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` that a partner may lack."""
    return (100 - percent) * n // 100


def _asked(n: int) -> int:
    return max(1, -(-n // SCREEN))


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))


def _low(batches, size: int, percent: int):
    """``(doc_id, h1, h2, n, low)``: set sizes and the lowest shingles."""
    for piece in pieces(batches, "text", _PIECE_BYTES):
        found, starts = shingle_sets(piece.column("text").to_pylist(), size)
        n = np.diff(starts)
        taken = np.array([min(k, missing(k, percent) + _asked(k)) for k in n.tolist()], np.int64)
        keep = np.arange(len(found)) - np.repeat(starts[:-1], n) < np.repeat(taken, n)
        low = _lists(found[keep].astype(np.int64), np.concatenate([[0], np.cumsum(taken)]))
        columns = [piece.column(c) for c in ("doc_id", "h1", "h2")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), low], names=["doc_id", "h1", "h2", "n", "low"])


def _whole(batches, size: int):
    """``(node, tokens)``: whole sets."""
    for piece in pieces(batches, "text", _PIECE_BYTES):
        found, starts = shingle_sets(piece.column("text").to_pylist(), size)
        yield pa.RecordBatch.from_arrays([piece.column("node"), _lists(found.astype(np.int64), starts)], names=["node", "tokens"])


def signatures(n: int, unique: int, counts: np.ndarray, tokens: np.ndarray, percent: int) -> np.ndarray:
    """Prefix entries of a set of ``n`` shingles: ``unique`` in no other set, then ``tokens`` from rare to frequent.

    Partners' sizes lie in the same band of sizes or the next one, and they meet in the
    larger band, which says how many cells there are.  Some entry is shared with each:
    the prefix's score is the number of shingles a partner has to lack to avoid that.
    """
    needed = missing(n, percent) + 1
    if n == 1 or unique >= needed:
        return mixed(tokens) if n == 1 else tokens[:0]
    out = []
    band = n if percent == 100 else math.floor(math.log(n) / math.log(100 / percent) + 1e-9)
    for meeting in (band, band + 1)[: 1 if percent == 100 else 2]:
        cells = 1 + missing(math.ceil((100 / percent) ** (meeting + 1)), percent) // 3
        cell = (mixed(tokens + np.uint64(meeting)) % np.uint64(cells)).astype(np.int64)
        score, frequent = unique, {}
        for k in range(len(tokens)):
            if counts[k] <= RARE:
                score += 1
                out.append(mixed(tokens[k : k + 1]))
            else:
                own = frequent.setdefault(int(cell[k]), [])
                score += bool(own)
                own.append(k)
            if score >= needed:
                break
        for own in frequent.values():
            if len(own) > 1:
                a, b = np.triu_indices(len(own), 1)
                own = np.array(own)
                pair = mixed(tokens[own[a]]) + np.uint64(3) * mixed(tokens[own[b]] + np.uint64(1))
                out.append(mixed(pair + np.uint64(meeting * 2 + 1)))
    return np.unique(np.concatenate(out)) if out else tokens[:0]


def _signed(batches, percent: int):
    for batch in batches:
        starts = batch.column("own").offsets.to_numpy()
        own = batch.column("own").values
        counts, tokens = own.field("c").to_numpy(), own.field("token").to_numpy().astype(np.uint64)
        sizes = batch.column("n").to_pylist()
        found = [signatures(n, n - int(b - a), counts[a:b], tokens[a:b], percent) for n, a, b in zip(sizes, starts, starts[1:])]
        nodes = np.repeat(batch.column("node").to_numpy(), [len(f) for f in found])
        signs = np.concatenate(found) if found else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(signs.astype(np.int64))], names=["node", "sign"])


def _links(group: pa.RecordBatch, percent: int):
    """``(node, root, links)`` of the texts of a group that link with others of it."""
    _, first = np.unique(group.column("node").to_numpy(), return_index=True)
    group = group.take(pa.array(first))
    nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
    chunk, tokens = group.column("chunk").to_numpy(), group.column("tokens")
    n = np.diff(tokens.offsets.to_numpy())
    flat, row = tokens.flatten().to_numpy(), np.repeat(np.arange(len(nodes)), n)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1 if len(flat) else np.empty(0, bool)
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    common = np.zeros((len(nodes), len(nodes)), np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        has = np.zeros((len(nodes), _COLUMNS), np.float32)
        has[row[a:b], column[a:b] - low] = 1
        common += has @ has.T
    linked = 100 * common.astype(np.int64) >= percent * (n[:, None] + n[None, :] - common.astype(np.int64))
    if group.column("i")[0].as_py() != group.column("j")[0].as_py():
        linked &= chunk[:, None] != chunk[None, :]
    np.fill_diagonal(linked, False)
    some = np.flatnonzero(linked.any(1))
    own = linked[np.ix_(some, some)]
    return nodes[some], nodes[some][forest(own)], own @ copies[some]


def _unique_and_common(tokens: DataFrame) -> DataFrame:
    """``(node, token, c)``: of ``(node, token)`` rows, how many tokens only that node has, and how many nodes a token.

    One of ``node`` and ``token`` is null.  A token with one row names its only node by
    its least, so no row has to look its count up.
    """
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
    alone = F.col("c") == 1
    keys = F.when(alone, F.col("node")).alias("node"), F.when(~alone, F.col("token")).alias("token")
    return counted.select(*keys, "c").groupBy("node", "token").agg(F.sum("c").alias("c"))


def jaccard_classes(
    documents: DataFrame,
    percent: int = 80,
    size: int = 5,
    chunk: int = CHUNK,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row.

    A set holds the distinct runs of ``size`` words of a text, A-Z lower-cased; a
    text with fewer words counts as one run; a text without words, empty or null
    has an empty set, links with nothing and is its own class.  ``percent`` (60 to
    100) is the least similarity that links.  ``component_id`` is the least id
    reachable by links, ``n_links`` the number of other rows linked directly.  A
    null id is never the least one unless the class has no other.  Equal rows are
    rows of their own.  An empty table gives an empty one.
    """
    if not 60 <= percent <= 100:
        raise ValueError("percent has to be between 60 and 100")
    named = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashes = [F.xxhash64(F.lit(k), "text").alias(f"h{k}") for k in (1, 2)]
    rows = named.select("doc_id", *hashes, F.col("text").cast("binary").alias("text"))
    sets = written(
        rows.mapInArrow(lambda b: _low(b, size, percent), "doc_id bigint, h1 bigint, h2 bigint, n bigint, low array<bigint>")
    )
    distinct = sets.filter("n > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.min("low").alias("low")
    )
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()))  # written, so that the numbers stay
    with_low, sets = sets, written(sets.drop("low"))
    discard(with_low)

    # 1. texts with enough low shingles that another text has as well
    low = distinct.select("node", F.explode("low").alias("token"))
    asked = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("n") * percent / 100) / SCREEN))
    alone = _unique_and_common(low).filter("token is null").select("node", "c")
    screened = distinct.join(alone, "node", "left").filter(F.size("low") - F.coalesce("c", F.lit(0)) >= asked)
    picked = written(screened.select("node", "h1", "h2", "least", "n", "copies"))
    with_low, distinct = distinct, written(distinct.select("node", "h1", "h2", "least", "copies"))
    discard(with_low)

    # 2. whole sets of these, from rare to frequent, and their prefix entries
    same = (F.col("d.h1") == F.col("p.h1")) & (F.col("d.h2") == F.col("p.h2")) & F.col("d.doc_id").eqNullSafe(F.col("p.least"))
    # what is picked grows with the texts, so it is never broadcast; equal rows may bring a set twice
    texts = rows.alias("d").join(picked.hint("merge").alias("p"), same).select("p.node", "d.text")
    whole = written(texts.mapInArrow(lambda b: _whole(b, size), "node bigint, tokens array<bigint>"))
    counts = written(_unique_and_common(whole.select("node", F.explode("tokens").alias("token"))))
    alone = counts.filter("token is null").select("node", F.col("c").alias("alone"))
    close = F.coalesce("alone", F.lit(0)) <= F.floor(F.col("n") * (100 - percent) / 100)
    near = written(picked.join(alone, "node", "left").filter(close).select("node", "n", "copies", "least"))
    all_whole, whole = whole, written(whole.join(near.select("node"), "node", "left_semi"))
    discard(all_whole)
    common = counts.filter("token is not null").select("token", "c")
    ordered = whole.select("node", F.explode("tokens").alias("token")).join(common, "token")
    ordered = ordered.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("c", "token"))).alias("own"))
    signed = ordered.join(near.select("node", "n"), "node").mapInArrow(lambda b: _signed(b, percent), "node bigint, sign bigint")
    signed = written(signed)

    # 3. families, and exact comparison inside them
    least = signed.groupBy("sign").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    ties = signed.join(written(least.select("sign", "hub")), "sign").select("node", "hub").distinct()
    families = written(connected_components(ties, "node", "hub"))
    sizes = families.join(near.select("node", "n"), "node").groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    chunks = F.greatest(F.ceil(F.col("members") / chunk), F.least("members", F.ceil(F.col("n") / CHUNK_SHINGLES))).cast("int")
    placed = families.join(written(sizes), "component").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    placed = placed.select("component", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    place = ["component", "i", "j"]
    members = whole.join(near.select("node", "copies"), "node")
    grouped = placed.join(members, "node").repartition(*place).sortWithinPartitions(*place)

    def compared(batches):
        for group in sorted_groups(batches, place):
            if group.num_rows > 1:
                found = _links(group, percent)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], names=["node", "root", "links"])

    links = written(grouped.mapInArrow(compared, "node bigint, root bigint, links bigint"))
    number = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = connected_components(links, "node", "root")
    least = classes.join(near.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("first"))
    classes = classes.join(least, "component").select("node", "first")
    known = distinct.select("node", "h1", "h2", "least", "copies").join(number, "node", "left").join(classes, "node", "left")
    known = written(known.select("h1", "h2", "copies", "links", F.coalesce("first", "least").alias("first")))
    answer = sets.select("doc_id", "h1", "h2", "n").join(known, ["h1", "h2"], "left")
    return answer.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
    )


def op2_jaccard_join(spark, folder):
    return jaccard_classes(spark.read.parquet(f"{folder}/documents.parquet"), percent=90, size=3)


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN generate_series(1, len(w) - 2)]) END AS s
  FROM d
), entries AS (
  SELECT r, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.r AS p, b.r AS q FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(r, t) AS (
  SELECT r, r FROM d UNION SELECT reach.r, q FROM reach JOIN pairs ON reach.t = pairs.p
), least AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id,
  CAST((SELECT count(*) FROM pairs WHERE p = sets.r) AS BIGINT) AS n_links
FROM sets JOIN least USING (r)
"""
