"""Categories from a table instead of a setting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_category(
    records: DataFrame, lookup: DataFrame, kind: str = "kind", *, key: str = "kind", category: str = "category", on_repeat: str = "fail"
) -> DataFrame:
    """The records with ``category``, looked up by ``kind`` in a table's ``key``; null where it is not there.

    No record is lost or doubled: keys that stand there twice with different
    categories stop the query (``on_repeat="fail"``), or the least category counts
    (``"least"``).  Null kinds and null keys match nothing, and a null category is none.

    A left join: Spark broadcasts the table if its measured size allows that, and
    beyond it the records have an exchange of their own, which adaptive execution can
    split where one kind has very many.
    """
    if on_repeat not in ("fail", "least"):
        raise ValueError(f"on_repeat must be fail or least, not {on_repeat!r}")
    least, most = F.min(F.col(f"`{category}`")), F.max(F.col(f"`{category}`"))
    found = lookup.where(F.col(f"`{key}`").isNotNull()).groupBy(F.struct(F.col(f"`{key}`").alias("key")).alias("_kind"))
    if on_repeat == "fail":
        clash = F.concat(F.lit("two categories for "), F.col("_kind.key").cast("string"))
        checked = F.when(F.col("_least") != F.col("_most"), F.raise_error(clash).cast(lookup.schema[category].dataType))
        found = found.agg(least.alias("_least"), most.alias("_most")).select("_kind", checked.otherwise(F.col("_least")).alias("_category"))
    else:
        found = found.agg(least.alias("_category"))
    others = [F.col(f"`{name}`") for name in records.columns if name != category]
    keyed = records.select(*others, F.struct(F.col(f"`{kind}`").alias("key")).alias("_kind"))
    joined = keyed.join(found, (keyed["_kind"] == found["_kind"]) & keyed["_kind.key"].isNotNull(), "left")
    return joined.select(*others, F.col("_category").alias(category))
