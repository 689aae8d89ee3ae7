"""Near-duplicate vectors by Euclidean p-stable hashing (operator 5).

Vectors of one label are scaled to length one and projected on random directions;
the projections, cut into cells of equal width, name a bucket in each of several
tables.  Near vectors share a bucket in some table almost surely.  Vectors that do
are compared exactly, each pair in the first table where they meet, so a pair is
counted once without ever being written down.

Equal vectors are one node from the start.  A large bucket is cut into chunks that
are compared two at a time, by as many tasks as there are pairs of chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import connected_components
from rollcall.llm.groups import forest, sorted_groups
from rollcall.plans.staging import written

#: Two vectors at the threshold meet in a table with probability 0.867 ** FUNCTIONS, and in none with less than 1e-4.
TABLES, FUNCTIONS, WIDTH = 26, 8, 1.2
SEED = 7
#: Vectors of a bucket that one task compares with each other or with as many others.
CHUNK = 512
_PAIRS = 1 << 16


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose rows are equally long."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _scaled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision times a power of two, so that no square leaves its range, and their lengths."""
    raw = _matrix(column).astype(float)
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(1, initial=0))[1][:, None])
    return raw, np.sqrt(np.einsum("ij,ij->i", raw, raw))


def _directions(size: int, tables: int, functions: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    draws = np.random.default_rng([SEED, size])
    return draws.standard_normal((size, tables * functions)), draws.uniform(0, width, tables * functions)


def bucket_numbers(units: np.ndarray, tables: int, functions: int, width: float) -> np.ndarray:
    """A number for the bucket of each vector in each table (rows: vectors)."""
    directions, shifts = _directions(units.shape[1], tables, functions, width)
    cells = np.floor((units @ directions + shifts) / width).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(units), tables, functions)
    out = np.broadcast_to(np.arange(tables, dtype=np.uint64) + np.uint64(units.shape[1] << 16), cells.shape[:2]).copy()
    for k in range(functions):
        out = (out ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def _compared(group: pa.RecordBatch, threshold: float):
    """``(node, root, n)`` for the vectors of a group that have links: a tie and their number."""
    nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
    chunk, labels = group.column("chunk").to_numpy(), group.column("label").dictionary_encode().indices.to_numpy()
    (vectors, norms), buckets = _scaled(group.column("vector")), _matrix(group.column("buckets"))
    units = vectors / norms[:, None]
    here = group.column("bucket")[0].as_py()
    apart = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    n, adjacent = np.zeros(len(nodes), np.int64), np.zeros((len(nodes), len(nodes)), bool)
    p, q = np.nonzero(np.triu(units @ units.T >= threshold - 1e-9, 1))
    for at in range(0, len(p), _PAIRS):
        a, b = p[at : at + _PAIRS], q[at : at + _PAIRS]
        own = (labels[a] == labels[b]) & ((chunk[a] != chunk[b]) | (not apart))
        a, b = a[own], b[own]
        met = buckets[a] == buckets[b]
        first = buckets[a, met.argmax(1)] == here
        own = first & (np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b]) >= threshold)
        a, b = a[own], b[own]
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        adjacent[a, b] = adjacent[b, a] = True
    some = np.flatnonzero(n)
    return nodes[some], nodes[some][forest(adjacent[np.ix_(some, some)])], n[some]


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    width: float = WIDTH,
    chunk: int = CHUNK,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors link if their labels, of any type that can be compared, are equal and their
    cosine, in double precision, is at least ``threshold``; components of any size count.  ``n_links`` counts the other rows linked directly,
    equal vectors included.  A row whose id, label or vector is null, whose vector
    is empty, zero, or holds null or non-finite components links with nothing: it
    is its own component and kept.  Vectors of different length never link.  Rows
    with one id count as rows of their own; of a component all rows with the least
    id are kept.  An empty table gives an empty one.
    """
    own = "float" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast(f"array<{own}>").alias("vector"), F.col(label).alias("label"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(sound & F.col("vec_id").isNotNull() & F.col("label").isNotNull(), F.lit(False))
    twins = [F.when(usable, F.xxhash64(F.lit(k), "label", "vector")).alias(f"twin{k}") for k in (1, 2)]
    counted = rows.filter(usable).groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    counted = written(counted.withColumn("node", F.monotonically_increasing_id()))  # written, so that the numbers stay
    fields = f"node bigint, copies bigint, label {rows.schema['label'].dataType.simpleString()}, vector array<{own}>, buckets array<bigint>"

    def bucketed(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector")])
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                raw, norms = _scaled(own.column("vector"))
                found = bucket_numbers(raw / norms[:, None], tables, functions, width)
                found ^= own.column("mark").to_numpy()[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * tables, pa.int32()), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("node", "copies", "label", "vector")), lists], names=[f.split()[0] for f in fields.split(", ")])

    nodes = written(counted.select("node", "copies", "label", "vector", F.xxhash64("label").alias("mark")).mapInArrow(bucketed, fields))
    members = nodes.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    sizes = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    shared = members.join(sizes, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    shared = shared.withColumn("other", other).select(
        "bucket", "node", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")
    )
    place = ["bucket", "i", "j"]
    grouped = shared.join(nodes, "node").repartition(*place).sortWithinPartitions(*place)

    def compared(batches):
        for group in sorted_groups(batches, place):
            if group.num_rows > 1:
                found = _compared(group, threshold)
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["node", "root", "n"])

    links = written(grouped.mapInArrow(compared, "node bigint, root bigint, n bigint"))
    linked = links.groupBy("node").agg(F.sum("n").alias("n"))
    classes = connected_components(links, "node", "root")
    least = classes.join(counted.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    classes = classes.join(least, "component").select("node", "least")
    keyed = counted.select("node", "rep", "copies", *[F.xxhash64(F.lit(k), "label", "vector").alias(f"twin{k}") for k in (1, 2)])
    whole = written(keyed.join(linked, "node", "left").join(classes, "node", "left"))
    answer = rows.select("vec_id", *twins).join(whole, ["twin1", "twin2"], "left")
    component = F.coalesce("least", "rep", "vec_id")
    return answer.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op5_embedding_dups(spark, folder):
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


# All pairs of a label; the hashing finds nearly all of these links.
OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), pairs AS (
  SELECT a.vec_id AS p, b.vec_id AS q FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98
), reach(r, t) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.r, q FROM reach JOIN pairs ON reach.t = pairs.p
), least AS (
  SELECT r AS vec_id, min(t) AS component_id FROM reach GROUP BY r
)
SELECT vec_id, CAST((SELECT count(*) FROM pairs WHERE p = embeddings.vec_id) AS BIGINT) AS n_links,
  component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id)
"""
