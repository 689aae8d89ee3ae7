"""Tool calls: links, order, validity and JSON against plain Python."""

from __future__ import annotations

import json
import random

from oracle import compare, connect
from pyspark.sql import functions as F

from rollcall.llm.tool_calls import OP9_SQL, REPLY, Maybe, link_tool_calls, op9_tool_calls, turns_as_calls

FOLDER = "/root/testdata/sf0.01"
CALLS = "conv_id int, call_id string, after string, name string, arguments string, turn int, depth string"
RESULTS = "conv_id int, call_id string, content string, turn int, status int"
SCHEMAS = {"t": {"x": "BIGINT", "b": "STRING?"}, "none": {}}


def linked(spark, calls, results):
    calls = spark.createDataFrame([(*row, "x") for row in calls], CALLS)
    return link_tool_calls(calls, spark.createDataFrame([(*row, 1) for row in results], RESULTS), SCHEMAS)


def test_query_matches_sql(spark):
    assert compare(op9_tool_calls(spark, FOLDER), connect(FOLDER), OP9_SQL) > 400


def test_random_traffic(spark):
    draw = random.Random(3)
    names = [f"c{k}" for k in range(30)]
    calls, results = [], []
    for conv in range(4):
        for turn, name in enumerate(draw.sample(names, 20)):
            calls.append((conv, name, draw.choice([None, *names]), "t", draw.choice(['{"x":1}', '{"x":"1"}', "no", None]), turn))
        results += [(conv, draw.choice(names), f"r{k}", draw.randrange(25)) for k in range(25)]
    own = {(c[0], c[1]): c for c in calls}

    def depth(conv, name, seen=()):
        if name in seen:
            return None
        after = own[conv, name][2]
        if (conv, after) not in own:
            return 0
        below = depth(conv, after, (*seen, name))
        return None if below is None else below + 1

    answered = {(c, i) for c, i, _, _ in results}
    expected = [
        (c, turn, "call", i, "linked" if (c, i) in answered else "unanswered", depth(c, i), text == '{"x":1}')
        for c, i, _, _, text, turn in calls
    ]
    for c, i, _, turn in results:
        call = own.get((c, i))
        status = "orphan" if call is None else "linked" if turn > call[5] else "early"
        expected.append((c, turn, "result", i, status, call and depth(c, i), bool(call) and call[4] == '{"x":1}'))
    found = linked(spark, calls, results).drop("problems", "json").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_order_follows_dependencies(spark):
    calls = [(1, f"k{k}", f"k{k - 1}", "t", '{"x":1}', 100 - k) for k in range(70)]
    found = {r.call_id: r.depth for r in linked(spark, calls, []).collect()}
    assert found == {f"k{k}": k for k in range(70)}


def test_json_and_problems(spark):
    calls = [
        (1, "a", None, "t", '{ "x" : 3, "b":"é\\n\\"" }', 0),
        (1, "a", None, "t", '{"y":{"k":[1,2.50],"a":null},"x":3}', 5),
        (1, "n", None, "none", "{}", 1),
        (1, "u", None, "other", "{}", 1),
        (1, "l", None, "t", "[1]", 1),
        (None, "z", "a", "t", '{"x":true}', 0),
        (2, None, None, None, None, None),
    ]
    results = [(1, "a", "ok", 1), (1, None, None, 9), (2, "q", "x", None)]
    found = [tuple(r)[2:] for r in linked(spark, calls, results).collect()]
    assert sorted(found, key=repr) == sorted(
        [
            ("call", "a", "linked", 0, True, [], '{"arguments":{"b":"é\\n\\"","x":3},"id":"a","name":"t","type":"call"}'),
            ("call", "a", "repeated", 0, False, ["y is unknown"], '{"arguments":{"x":3,"y":{"a":null,"k":[1,2.5]}},"id":"a","name":"t","type":"call"}'),
            ("call", "n", "unanswered", 0, True, [], '{"arguments":{},"id":"n","name":"none","type":"call"}'),
            ("call", "u", "unanswered", 0, False, ["no such tool"], '{"arguments":{},"id":"u","name":"other","type":"call"}'),
            ("call", "l", "unanswered", 0, False, ["arguments are no JSON object"], '{"arguments":[1],"id":"l","name":"t","type":"call"}'),
            ("call", "z", "unanswered", None, False, ["x is not BIGINT"], '{"arguments":{"x":true},"id":"z","name":"t","type":"call"}'),
            ("call", None, "unanswered", None, False, ["arguments are no JSON object"], '{"arguments":null,"id":null,"name":null,"type":"call"}'),
            ("result", "a", "linked", 0, True, [], '{"content":"ok","id":"a","type":"result"}'),
            ("result", None, "orphan", None, False, [], '{"content":null,"id":null,"type":"result"}'),
            ("result", "q", "orphan", None, False, [], '{"content":"x","id":"q","type":"result"}'),
        ],
        key=repr,
    )
    for row in found:
        assert json.dumps(json.loads(row[-1]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == row[-1]


def test_empty_tables(spark):
    assert linked(spark, [], []).count() == 0


def test_nested_schemas(spark):
    schemas = {"t": {"at": {"x": "NUMBER", "to": Maybe({"y": "STRING"})}, "tags": [{"red", "blue"}], "rows": Maybe([["BIGINT"]])}}
    texts = {
        '{"at":{"x":1.5},"tags":[]}': [],
        '{"at":{"x":2,"to":{"y":"k"}},"tags":["red","blue","red"],"rows":[[1],[],[2,3]]}': [],
        '{"at":{"x":"1","to":{"z":1}},"tags":["red","green",3]}': [
            "at.x is not NUMBER", "at.to.y is missing", "at.to.z is unknown", "tags[1] is none of blue, red", "tags[2] is none of blue, red",
        ],
        '{"at":[1],"tags":{"k":1},"rows":[[1],2,["k",4]]}': ["at is not OBJECT", "tags is not ARRAY", "rows[1] is not ARRAY", "rows[2][0] is not BIGINT"],
        '{"at":null,"rows":null}': ["at is not OBJECT", "tags is missing", "rows is not ARRAY"],
    }
    calls = spark.createDataFrame([(1, f"c{k}", None, "t", text, k, "x") for k, text in enumerate(texts)], CALLS)
    found = link_tool_calls(calls, spark.createDataFrame([], RESULTS), schemas).collect()
    assert {r.turn: r.problems for r in found} == dict(enumerate(texts.values()))


def test_turns_of_every_role(spark, tmp_path):
    long = "é " * 300_000
    rows = [
        (1, 0, "system", "first"), (1, 1, "system", "second"), (1, 2, "user", long), (1, 3, "assistant", None), (1, 4, "user", ""),
        (2, 0, "user", None), (2, 1, "tool", "t"), (2, 2, None, None), (2, 0, "system", None), (3, 0, "assistant", "alone"),
        (3, 1, "other", "x"), (3, 1, "other", "x"),
    ]
    turns = spark.createDataFrame([(*row, "k") for row in rows], "conv_id long, turn long, role string, text string, system string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    connection = connect(FOLDER)
    connection.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare(op9_tool_calls(spark, str(tmp_path)), connection, OP9_SQL) == len(rows)
    nobody = turns.withColumn("conv_id", F.lit(None).cast("long"))
    calls, results, others = turns_as_calls(nobody)
    assert link_tool_calls(calls, results, REPLY, others).count() == len(rows)
    calls, results, others = turns_as_calls(turns.limit(0))
    assert link_tool_calls(calls, results, REPLY, others).count() == 0
