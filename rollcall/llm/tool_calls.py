"""Tool calls of chats linked with their results (operator 9).

Calls and results meet by conversation and identifier, are put in an order in
which everything follows what it depends on, have their arguments checked against
the tool's schema, and become canonical JSON: sorted keys, no blanks, every field
present.  DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence, Set
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.plans.staging import written

#: What a value has to be: the name of a JSON type (``STRING``, ``BIGINT``, ``BOOLEAN``, ...,
#: ``NUMBER`` for any of the numbers); a mapping, for an object with these fields; a list
#: of one kind, for an array of such values; a set of texts, for one of these.  A field
#: whose kind is ``Maybe(kind)``, or a type's name with ``?``, may be missing.
Kind = str | Mapping | Sequence | Set


class Maybe(NamedTuple):
    kind: Kind


#: Of each tool, the kinds of its arguments.
Schemas = Mapping[str, Mapping[str, Kind | Maybe]]
REPLY = {"reply": {"prompt": "STRING", "turn": "BIGINT", "system": "STRING?"}}


def _said(place: Column, text: str) -> Column:
    return F.array(F.concat(place, F.lit(text)))


def _misfits(value: Column, place: Column, kind: Kind) -> Column:
    """What is wrong with a value, as an array of texts that name its place."""
    nothing = F.array().cast("array<string>")
    found = F.schema_of_variant(value)
    if isinstance(kind, str):
        fits = found.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(found, F.lit("DECIMAL")) if kind == "NUMBER" else found == kind
        return F.when(fits, nothing).otherwise(_said(place, f" is not {kind}"))
    if isinstance(kind, Mapping):
        inside = _object_misfits(value, F.concat(place, F.lit(".")), kind)
        return F.when(F.startswith(found, F.lit("OBJECT")), inside).otherwise(_said(place, " is not OBJECT"))
    if isinstance(kind, Set):
        fits = (found == "STRING") & F.try_variant_get(value, "$", "string").isin(*sorted(kind))
        return F.when(fits, nothing).otherwise(_said(place, f" is none of {', '.join(sorted(kind))}"))
    (item,) = kind
    where = lambda k: F.concat(place, F.lit("["), k.cast("string"), F.lit("]"))
    items = F.try_variant_get(value, "$", "array<variant>")
    inside = F.flatten(F.transform(items, lambda one, k: _misfits(one, where(k), item)))
    return F.when(F.startswith(found, F.lit("ARRAY")), inside).otherwise(_said(place, " is not ARRAY"))


def _object_misfits(value: Column, place: Column, fields: Mapping[str, Kind | Maybe]) -> Column:
    """What is wrong with the fields of an object: those of the schema in its order, then unknown ones by name."""
    found = []
    for field, kind in fields.items():
        optional = isinstance(kind, Maybe) or (isinstance(kind, str) and kind.endswith("?"))
        kind = kind.kind if isinstance(kind, Maybe) else kind.removesuffix("?") if isinstance(kind, str) else kind
        own, name = F.try_variant_get(value, f'$["{field}"]', "variant"), F.concat(place, F.lit(field))
        absent = F.array().cast("array<string>") if optional else _said(name, " is missing")
        found.append(F.when(own.isNull(), absent).otherwise(_misfits(own, name, kind)))
    extra = F.array_sort(F.array_except(F.json_object_keys(F.to_json(value)), F.array(*map(F.lit, fields)).cast("array<string>")))
    return F.concat(*found, F.transform(extra, lambda name: F.concat(place, name, F.lit(" is unknown"))))


def _problems(parsed: Column, name: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, as an array of texts."""
    is_object = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    checks = F.lit(None).cast("array<string>")
    for tool, fields in schemas.items():
        checks = F.when(name == tool, _object_misfits(parsed, F.lit(""), fields)).otherwise(checks)
    return (
        F.when(parsed.isNull() | ~is_object, F.array(F.lit("arguments are no JSON object")))
        .otherwise(F.coalesce(checks, F.array(F.lit("no such tool"))))
    )


def _depths(heads: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)``: calls before it in its chain; null on or behind a cycle.

    Pointers double each round, so rounds grow with the logarithm of the longest chain.
    """
    up = heads.select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("known"))
    chains = heads.select("conv_id", "call_id", F.col("after").alias("up")).join(up, ["conv_id", "up"], "left")
    steps = F.when(F.col("known"), 1).otherwise(0).cast("bigint")
    chains = written(chains.select("conv_id", "call_id", F.when(F.col("known"), F.col("up")).alias("up"), steps.alias("depth")))
    waiting = chains.filter("up is not null").count()
    while waiting:
        above = chains.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        chains = written(
            chains.join(above, ["conv_id", "up"], "left").select(
                "conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            )
        )
        before, waiting = waiting, chains.filter("up is not null").count()
        if waiting == before:
            break
    return chains.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas, others: DataFrame | None = None) -> DataFrame:
    """Every call and every result, linked, ordered, checked and serialised.

    ``calls`` has ``conv_id, call_id, after, name, arguments, turn`` (``after``: the
    identifier of the call it depends on, or null), ``results`` has ``conv_id,
    call_id, content, turn``; ``others``, turns that are neither, ``conv_id, turn, role,
    content``; other columns are not read.  The answer has a row for each row of them:
    ``conv_id, turn, kind`` (call, result, turn), ``call_id, status, depth, valid,
    problems, json``.

    A call is ``linked`` if a result has its identifier, else ``unanswered``; of
    calls with one identifier the first by turn counts, later ones are
    ``repeated`` (equal turns: all count, their rows are equally first).  A result
    is ``linked``, ``early`` (not after its call) or an ``orphan``; several results of
    a call are all linked.  Rows with a null conversation or identifier meet nothing:
    ``unanswered`` or ``orphan``.  ``depth`` is the number of calls a call waits for
    along ``after`` and is null on a cycle; an unknown ``after`` counts as none.
    Results share the depth and validity of their call.  Sorting by ``depth, kind,
    turn, call_id`` within a conversation is a topological order.  Arguments that are
    null or no JSON object, an unknown tool, a missing, unknown or wrongly typed
    field make a call invalid.  Turns of others have no identifier and no depth: those of
    the system are ``context``, of any other or no role ``unknown`` and invalid.
    Conversations are never gathered into one row.
    """
    key = ["conv_id", "call_id"]
    calls = calls.select(*key, "after", "name", "arguments", "turn")
    results = results.select(*key, "content", "turn")
    parsed = F.try_parse_json("arguments")
    calls = calls.withColumn("problems", _problems(parsed, F.col("name"), schemas))
    first = F.min(F.struct("turn", F.struct("after", "name", F.size("problems").alias("wrong")).alias("own"))).alias("first")
    heads = calls.dropna(subset=key).groupBy(*key).agg(first)
    heads = written(heads.select(*key, F.col("first.turn").alias("first_turn"), "first.own.after", (F.col("first.own.wrong") == 0).alias("sound")))
    depths = _depths(heads)
    heads = heads.join(depths, key, "left").select(*key, "first_turn", "sound", "depth")
    answers = results.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("answers"))
    heads = written(heads.join(answers, key, "left"))  # plain exchanges below, which Spark can split at a hot identifier

    def serialised(**fields: Column) -> Column:
        names = sorted(fields)
        return F.to_json(F.struct(*[fields[n].alias(n) for n in names]), {"ignoreNullFields": "false"})

    later = F.col("turn") > F.col("first_turn")
    call_status = F.when(later, F.lit("repeated")).when(F.col("answers") > 0, F.lit("linked")).otherwise(F.lit("unanswered"))
    call_rows = calls.join(heads, key, "left").select(
        "conv_id",
        "turn",
        F.lit("call").alias("kind"),
        "call_id",
        call_status.alias("status"),
        "depth",
        (F.size("problems") == 0).alias("valid"),
        "problems",
        serialised(arguments=parsed, id=F.col("call_id"), name=F.col("name"), type=F.lit("call")).alias("json"),
    )
    result_status = F.when(F.col("first_turn").isNull(), F.lit("orphan")).when(later, F.lit("linked")).otherwise(F.lit("early"))
    result_rows = results.join(heads, key, "left").select(
        "conv_id",
        "turn",
        F.lit("result").alias("kind"),
        "call_id",
        result_status.alias("status"),
        "depth",
        F.coalesce("sound", F.lit(False)).alias("valid"),
        F.array().cast("array<string>").alias("problems"),
        serialised(content=F.col("content"), id=F.col("call_id"), type=F.lit("result")).alias("json"),
    )
    linked = call_rows.unionAll(result_rows)
    if others is None:
        return linked
    system = F.coalesce(F.col("role") == "system", F.lit(False))
    return linked.unionAll(
        others.select(
            "conv_id",
            "turn",
            F.lit("turn").alias("kind"),
            F.lit(None).cast("string").alias("call_id"),
            F.when(system, F.lit("context")).otherwise(F.lit("unknown")).alias("status"),
            F.lit(None).cast("bigint").alias("depth"),
            system.alias("valid"),
            F.when(system, F.array().cast("array<string>")).otherwise(F.array(F.lit("no such role"))).alias("problems"),
            serialised(content=F.col("content"), role=F.col("role"), type=F.lit("turn")).alias("json"),
        )
    )


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chat turns as traffic with one tool: a user's turn calls for the reply two speakers give in turn.

    The call of turn ``t`` is named by conversation and turn and depends on that of
    ``t - 2``; the assistant's turn ``t + 1`` is its result.  A conversation's first system
    turn that has a text (the least text of equal turns) is an argument of all its calls.
    The third table has the turns that are neither call nor result, with their role.
    """
    identifier = lambda turn: F.concat_ws("-", "conv_id", turn)
    systems = turns.filter("role = 'system' and text is not null and conv_id is not null")
    systems = systems.groupBy("conv_id").agg(F.min(F.struct("turn", "text"))["text"].alias("system"))
    # written, so that the join has plain exchanges, which Spark can split at a long conversation
    asked = turns.filter("role = 'user'").select("conv_id", "turn", "text").join(written(systems), "conv_id", "left")
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "system", F.col("turn").cast("bigint").alias("turn")))
    calls = asked.select(
        "conv_id",
        identifier(F.col("turn")).alias("call_id"),
        identifier(F.col("turn") - 2).alias("after"),
        F.lit("reply").alias("name"),
        arguments.alias("arguments"),
        "turn",
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id", identifier(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"), "turn"
    )
    others = turns.filter("role is null or role not in ('user', 'assistant')")
    return calls, results, others.select("conv_id", "turn", "role", F.col("text").alias("content"))


def op9_tool_calls(spark, folder):
    calls, results, others = turns_as_calls(spark.read.parquet(f"{folder}/conversations.parquet"))
    linked = link_tool_calls(calls, results, REPLY, others)
    return linked.withColumn("problems", F.array_join("problems", "; "))


OP9_SQL = """
WITH calls AS (
  SELECT conv_id, turn, text, conv_id || '-' || turn AS call_id,
    turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
  FROM conversations WHERE role = 'user'
), deep AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS depth FROM calls
), results AS (
  SELECT conv_id, turn, text, conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), systems AS (
  SELECT conv_id, text FROM conversations WHERE role = 'system' AND text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, text) = 1
)
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id,
  CASE WHEN EXISTS (SELECT 1 FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id) THEN 'linked' ELSE 'unanswered' END AS status,
  CAST(c.depth AS BIGINT) AS depth, c.text IS NOT NULL AS valid,
  CASE WHEN c.text IS NULL THEN 'prompt is missing' ELSE '' END AS problems,
  '{"arguments":{' || coalesce('"prompt":' || to_json(c.text) || ',', '') || coalesce('"system":' || to_json(s.text) || ',', '')
    || '"turn":' || c.turn || '},"id":"' || c.call_id || '","name":"reply","type":"call"}' AS json
FROM deep c LEFT JOIN systems s ON s.conv_id = c.conv_id
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END,
  CAST(c.depth AS BIGINT), coalesce(c.text IS NOT NULL, false), '',
  '{"content":' || coalesce(to_json(r.text), 'null') || ',"id":"' || r.call_id || '","type":"result"}'
FROM results r LEFT JOIN deep c ON c.conv_id = r.conv_id AND c.call_id = r.call_id
UNION ALL
SELECT conv_id, turn, 'turn', NULL, CASE WHEN role = 'system' THEN 'context' ELSE 'unknown' END, NULL,
  coalesce(role = 'system', false), CASE WHEN role = 'system' THEN '' ELSE 'no such role' END,
  '{"content":' || coalesce(to_json(text), 'null') || ',"role":' || coalesce(to_json(role), 'null') || ',"type":"turn"}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""
