"""Chat-log jobs on inline fixtures (group C: response items, history)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from plantlens.plans import transcripts as X


def _items(spark, items_per_request):
    rows = []
    for conv, items in items_per_request.items():
        for turn, it in enumerate(items):
            rows.append((conv, turn, json.dumps(it)))
    return spark.createDataFrame(rows, "conv_id long, turn long, item_json string")


ITEMS = {
    1: [
        {"type": "message", "content": [{"type": "output_text", "text": "Hello"},
                                        {"type": "output_text", "text": " world"}]},
        {"type": "function_call", "call_id": "c1", "name": "lookup", "arguments": "{\"q\": 1}"},
        {"type": "function_call_output", "call_id": "c1", "output": "42"},
        {"type": "reasoning", "content": []},
    ],
    2: [{"type": "message", "content": []}],
}


def test_flatten_streamed(spark):
    rows = X.flatten_items_streamed(_items(spark, ITEMS)).orderBy("conv_id", "turn", "part_idx").collect()
    got = [(r.conv_id, r.role, r.content, r.tool_call_id) for r in rows]
    assert got == [(1, "assistant", "Hello", None), (1, "assistant", " world", None),
                   (1, "assistant", "", "c1"), (1, "tool", "42", "c1")]


def test_flatten_joined_and_empty_request(spark):
    rows = X.flatten_items_joined(_items(spark, ITEMS)).collect()
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r.conv_id, []).append((r.role, r.content))
    assert ("assistant", "Hello world") in by_conv[1]
    assert by_conv[2] == [("assistant", X.NO_RESPONSE_TEXT)]


def test_history_items(spark):
    calls = [("c:1", "tool", "a1"), ("c:2", "tool", "a2")]
    rows = [(1, 0, "user", "hi", None, None, None),
            (1, 1, "assistant", "text only", None, None, None),
            (1, 2, "assistant", "and calls", calls, None, "kept"),
            (1, 3, "assistant", "", calls[:1], None, None),
            (1, 4, "tool", "result", None, "c:1", None),
            (1, 5, "other", "x", None, None, None)]
    h = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string, "
                                    "tool_calls array<struct<id:string,name:string,arguments:string>>, "
                                    "tool_call_id string, message_id string")
    out = X.history_items(h).withColumn("item", X.item_json()).orderBy("turn", "item_seq").collect()
    got = [(r.turn, r.type, r.call_id, r.content, [p.text for p in r.parts or ()], r.output) for r in out]
    assert got == [
        (0, None, None, "hi", [], None),                          # a user item has no type
        (1, "message", None, None, ["text only"], None),
        (2, "function_call", "c:1", None, [], None), (2, "function_call", "c:2", None, [], None),
        (2, "message", None, None, ["and calls"], None),
        (3, "function_call", "c:1", None, [], None),              # empty text: no message item
        (4, "function_call_output", "c:1", None, [], "result"),
    ]
    assert out[1].id == "msg-1-1" and out[4].id == "kept"         # ids from (conv, turn), repeatable; a logged one stays
    assert [json.loads(r.item) for r in out] == [
        {"role": "user", "content": "hi"},
        {"type": "message", "id": "msg-1-1", "content": [{"type": "output_text", "text": "text only"}], "role": "assistant"},
        {"type": "function_call", "id": "c:1", "call_id": "c:1", "name": "tool", "arguments": "a1"},
        {"type": "function_call", "id": "c:2", "call_id": "c:2", "name": "tool", "arguments": "a2"},
        {"type": "message", "id": "kept", "content": [{"type": "output_text", "text": "and calls"}], "role": "assistant"},
        {"type": "function_call", "id": "c:1", "call_id": "c:1", "name": "tool", "arguments": "a1"},
        {"type": "function_call_output", "call_id": "c:1", "output": "result"}]


def test_text_parts_only(spark):
    df = spark.createDataFrame([("a\nIMG\nb",), ("",)], "t string")
    got = [r.x for r in df.select(X.text_parts_joined(X.alternating_parts(F.col("t"))).alias("x")).collect()]
    assert got == ["ab", ""]


def test_message_fold_rebuilds_text_in_order(spark):
    msgs = spark.createDataFrame([(1, 0, "user", "one two  three "), (1, 1, "assistant", "x")],
                                 "conv_id long, turn long, role string, text string")
    chunks = X.word_chunks(msgs).repartition(5)                  # arrival order scrambled by the shuffle
    got = {r.turn: r.content for r in X.fold_message_chunks(chunks).collect()}
    assert got == {0: "one two  three ", 1: "x"}


def test_tool_call_fold(spark):
    rows = [(1, 1, "c1", 0, "function", "get", "{\"a\""), (1, 1, "c1", 1, "function", "", ": 1"),
            (1, 1, "c1", 2, "function", "get_v2", "}"), (1, 1, "c2", 3, "function", "", "{}"),
            (2, 1, "c1", 0, "function", "other", "x"), (2, 1, None, 1, "function", "lost", "y"), (2, 1, "", 2, "function", "lost", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, seq int, type string, name string, arguments string")
    calls = X.fold_tool_call_chunks(df.repartition(3))
    got = {(r.conv_id, r.call_id): (r.name, r.arguments) for r in calls.collect()}
    assert got == {(1, "c1"): ("get_v2", "{\"a\": 1}"), (1, "c2"): ("", "{}"), (2, "c1"): ("other", "x")}
    messages = spark.createDataFrame([(1, 1, "a"), (3, 1, "b")], "conv_id long, turn long, content string")
    out = {r.conv_id: r for r in X.messages_with_calls(messages, calls).collect()}
    assert [c.id for c in out[1].tool_calls] == ["c1", "c2"] and out[1].tool_call_id == "c2"
    assert out[3].tool_calls == [] and out[3].tool_call_id is None


def test_completion_fold_last_request_id(spark):
    rows = [(1, 3, 0, "Hel", None), (1, 3, 1, "lo", "r1"), (1, 3, 2, "!", "r2"), (1, 3, 3, "", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, seq int, content string, request_id string")
    r = X.fold_completion_deltas(df.repartition(3)).collect()[0]
    assert (r.content, r.request_id) == ("Hello!", "r2")


def test_feedback_rows(spark):
    df = spark.createDataFrame([("r1", 1), ("r2", 0), ("r3", None)], "request_id string, rating int")
    got = {r.request_id: (r.rating_string, json.loads(r.text_assessments)) for r in X.feedback_rows(df).collect()}
    assert got["r1"][0] == "positive"
    assert got["r1"][1][0]["ratings"]["answer_correct"]["value"] == "positive"
    assert "free_text_comment" in got["r1"][1][0]
    assert got["r2"][0] == "negative"
    assert got["r3"] == (None, [])
    named = X.feedback_rows(df.withColumn("by", F.lit("web")), source="by").collect()
    assert {r.source for r in named} == {"web"}


def test_name_collisions(spark):
    df = spark.createDataFrame([("my doc",), ("my-doc",), ("my.doc",), ("other",)], "name string")
    got = {r.normalized_name: (r.n_raw_names, r.collides) for r in X.name_report(df).collect()}
    assert got["my_doc"] == (2, True)          # 'my doc' and 'my.doc'
    assert got["my-doc"] == (1, False)
