"""Chat-log jobs (X3-X10): chunk folding, item flattening, feedback rows and
name rules, as DataFrame jobs over logged tables.

The reference does this per message in a UI process; here every fold is a
grouped aggregate keyed by message (or call id), so a conversation log of
any size is processed in parallel, and each group holds exactly the chunks
of one output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.functions import columns as C

# Fixed values that must equal the reference for right results.
NO_RESPONSE_TEXT = "No response found"
DEFAULT_NAME = "knowledge_assistant"
RATING_POSITIVE, RATING_NEGATIVE = "positive", "negative"


def ordered_concat(seq: str, content: str) -> Column:
    """Concatenate ``content`` in ``seq`` order inside a group.

    ``collect_list`` alone has no order; sorting the (seq, content) structs
    makes the result independent of shuffle order and task retries."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(content).alias("c"))))
    return F.array_join(F.transform(parts, lambda x: x["c"]), "")


# ---- X3: streamed chunks -> messages ---------------------------------------

def word_chunks(messages: DataFrame, keys=("conv_id", "turn", "role"), text: str = "text") -> DataFrame:
    """A chunk log from whole messages: one chunk per space-separated word,
    the separator kept at the front of every chunk but the first, so folding
    rebuilds the text exactly."""
    exploded = messages.select(*keys, F.posexplode(F.split(F.col(text), " ")).alias("seq", "word"))
    return exploded.select(*keys, "seq",
                           F.when(F.col("seq") > 0, F.concat(F.lit(" "), F.col("word")))
                           .otherwise(F.col("word")).alias("content"))


def fold_message_chunks(chunks: DataFrame, keys=("conv_id", "turn", "role"),
                        seq: str = "seq", content: str = "content") -> DataFrame:
    """Content of a message = its chunks concatenated by arrival order;
    NULL/empty chunks add nothing."""
    return chunks.groupBy(*keys).agg(
        ordered_concat(seq, content).alias("content"),
        F.count(F.lit(1)).alias("n_chunks"),
    )


def fold_tool_call_chunks(chunks: DataFrame, message=("conv_id", "turn"), call_key: str = "call_id",
                          seq: str = "seq") -> DataFrame:
    """Tool calls per message and call id: arguments appended in order; the
    first chunk sets type and name, a later non-empty name replaces it.  Chunks
    without a call id are skipped; equal ids in two messages are two calls."""
    named_seq = F.when(F.coalesce(F.col("name"), F.lit("")) != "", F.col(seq))
    known = chunks.filter(F.coalesce(F.col(call_key), F.lit("")) != "")
    return known.groupBy(*message, call_key).agg(
        F.min(seq).alias("first_seq"),
        F.min_by("type", seq).alias("type"),
        F.coalesce(F.max_by("name", named_seq), F.min_by("name", seq)).alias("name"),
        ordered_concat(seq, "arguments").alias("arguments"),
        F.count(F.lit(1)).alias("n_chunks"),
    )


def messages_with_calls(messages: DataFrame, calls: DataFrame, key=("conv_id", "turn")) -> DataFrame:
    """A folded message with its calls in order of arrival, and the id of
    the last; messages without a call get an empty list."""
    one = F.struct("first_seq", "call_id", "type", "name", "arguments")
    of = calls.groupBy(*key).agg(F.sort_array(F.collect_list(one)).alias("c"))     # the calls of one message
    joined = messages.join(of, list(key), "left")
    calls_of = F.transform("c", lambda x: F.struct(x["call_id"].alias("id"), x["type"].alias("type"), x["name"].alias("name"),
                                                   x["arguments"].alias("arguments")))
    empty = F.array().cast("array<struct<id:string,type:string,name:string,arguments:string>>")
    return joined.select(*messages.columns, F.coalesce(calls_of, empty).alias("tool_calls"),
                         F.element_at(F.col("c"), -1)["call_id"].alias("tool_call_id"))


def line_tool_chunks(messages: DataFrame) -> DataFrame:
    """Tool-call chunk log from assistant messages: every line is an argument
    fragment of one call (ids repeat in other messages); the first chunk names the call 'lookup',
    the last (when there are several) renames it 'final'."""
    a = messages.filter(F.col("role") == "assistant")
    lines = a.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("seq", "line"),
                     F.size(F.split("text", "\n")).alias("n"))
    last = F.col("seq") == F.col("n") - 1
    return lines.select(
        "conv_id", "turn",
        F.concat(F.lit("call-"), (F.col("conv_id") % 7).cast("string")).alias("call_id"),
        "seq",
        F.lit("function").alias("type"),
        F.when(F.col("seq") == 0, F.lit("lookup")).when(last, F.lit("final")).otherwise(F.lit("")).alias("name"),
        F.when(last, F.col("line")).otherwise(F.concat(F.col("line"), F.lit("\n"))).alias("arguments"),
    )


# ---- X4: completion deltas ------------------------------------------------

def fold_completion_deltas(deltas: DataFrame, keys=("conv_id", "turn"), seq: str = "seq",
                           content: str = "content", request_id: str = "request_id") -> DataFrame:
    """Concatenated deltas per streamed completion and the last request id
    seen.  The group is one completion, i.e. exactly one output text."""
    return deltas.groupBy(*keys).agg(
        ordered_concat(seq, content).alias("content"),
        F.max_by(request_id, F.when(F.col(request_id).isNotNull(), F.col(seq))).alias("request_id"),
        F.count(F.lit(1)).alias("n_deltas"),
    )


# ---- X5: response items -> role rows --------------------------------------

PART = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType())])
ITEM = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("content", T.ArrayType(PART)),
    T.StructField("call_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("arguments", T.StringType()),
    T.StructField("output", T.StringType()),
])


def response_items(conversations: DataFrame) -> DataFrame:
    """Response items (as JSON text) derived from logged turns: assistant turns
    become messages with one output_text part per line, user turns function
    calls, system turns function-call outputs."""
    cid = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    parts = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit("output_text").alias("type"), x.alias("text")))
    none = F.lit(None).cast("string")
    item = (F.when(F.col("role") == "assistant",
                   F.struct(F.lit("message").alias("type"), parts.alias("content"), none.alias("call_id"),
                            none.alias("name"), none.alias("arguments"), none.alias("output")))
            .when(F.col("role") == "user",
                  F.struct(F.lit("function_call").alias("type"), F.lit(None).cast(T.ArrayType(PART)).alias("content"),
                           cid.alias("call_id"), F.lit("search").alias("name"), F.col("text").alias("arguments"),
                           none.alias("output")))
            .otherwise(F.struct(F.lit("function_call_output").alias("type"),
                                F.lit(None).cast(T.ArrayType(PART)).alias("content"), cid.alias("call_id"),
                                none.alias("name"), none.alias("arguments"), F.col("text").alias("output"))))
    return conversations.select("conv_id", "turn", F.to_json(item).alias("item_json"))


def flatten_items_streamed(items: DataFrame) -> DataFrame:
    """X5 (streamed): one row per non-empty output_text part of a message; a
    function call gives an assistant row with empty content; a call output a
    tool row.  Unknown item types give no row.

    One pass: each item becomes an array of its output rows, then a single
    explode (the JSON is parsed once)."""
    out_t = ("struct<part_idx:int,role:string,content:string,tool_call_id:string,"
             "tool_name:string,tool_arguments:string>")
    none = F.lit(None).cast("string")
    it = F.from_json("item_json", ITEM)
    typ = it["type"]
    parts = F.filter(
        F.transform(F.coalesce(it["content"], F.array().cast(T.ArrayType(PART))), lambda p, i: F.struct(
            i.alias("part_idx"), F.lit("assistant").alias("role"), p["text"].alias("content"),
            none.alias("tool_call_id"), none.alias("tool_name"), none.alias("tool_arguments"),
            p["type"].alias("_type"))),
        lambda r: (r["_type"] == "output_text") & (F.coalesce(r["content"], F.lit("")) != ""))
    parts = F.transform(parts, lambda r: F.struct(r["part_idx"], r["role"], r["content"], r["tool_call_id"],
                                                  r["tool_name"], r["tool_arguments"]))
    call = F.array(F.struct(F.lit(0).alias("part_idx"), F.lit("assistant").alias("role"), F.lit("").alias("content"),
                            it["call_id"].alias("tool_call_id"), it["name"].alias("tool_name"),
                            F.coalesce(it["arguments"], F.lit("")).alias("tool_arguments")))
    output = F.array(F.struct(F.lit(0).alias("part_idx"), F.lit("tool").alias("role"),
                              F.coalesce(it["output"], F.lit("")).alias("content"),
                              it["call_id"].alias("tool_call_id"), none.alias("tool_name"), none.alias("tool_arguments")))
    rows = (F.when(typ == "message", parts).when(typ == "function_call", call)
            .when(typ == "function_call_output", output).otherwise(F.array().cast(f"array<{out_t}>")))
    return items.select("conv_id", "turn", F.explode(rows).alias("r")).select("conv_id", "turn", "r.*")


def flatten_items_joined(items: DataFrame, request_key: str = "conv_id") -> DataFrame:
    """X5 (non-streamed): a message's output_text parts joined into one row
    (dropped when empty); a request that yields no row at all gets one
    'No response found' assistant row.

    The kept rows are a projection of the items.  Requests without one are the
    ids left by an anti join of ids alone, so no request's texts are gathered
    and a hot request is only a repeated key of a partial aggregate."""
    it = items.select(request_key, "turn", F.from_json("item_json", ITEM).alias("it"))
    texts = F.filter("it.content", lambda p: p["type"] == "output_text")
    joined = F.array_join(F.transform(texts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    typ = F.col("it.type")
    rows = it.select(
        request_key, "turn", typ.alias("item_type"),
        F.when(typ == "function_call_output", F.lit("tool")).otherwise(F.lit("assistant")).alias("role"),
        F.when(typ == "message", joined).when(typ == "function_call", F.lit(""))
        .when(typ == "function_call_output", F.coalesce(F.col("it.output"), F.lit(""))).alias("content"),
        F.when(typ.isin("function_call", "function_call_output"), F.col("it.call_id")).alias("tool_call_id"),
    )
    kept = (F.col("item_type").isin("message", "function_call", "function_call_output")
            & ~((F.col("item_type") == "message") & (F.col("content") == "")))
    found = rows.filter(F.coalesce(kept, F.lit(False)))
    silent = items.select(request_key).distinct().join(found.select(request_key).distinct(), request_key, "left_anti")
    placeholder = silent.select(
        request_key, F.lit(None).cast(items.schema["turn"].dataType).alias("turn"), F.lit("assistant").alias("role"),
        F.lit(NO_RESPONSE_TEXT).alias("content"), F.lit(None).cast("string").alias("tool_call_id"),
        F.lit("message").alias("item_type"))
    return found.select(placeholder.columns).union(placeholder)


# ---- X6: chat history -> request items ------------------------------------

PARTS = "array<struct<type:string,text:string>>"
ITEM_FIELDS = ["type", "role", "id", "call_id", "name", "arguments", "content", "parts", "output"]


def _item(**given: Column) -> Column:
    """One request item; fields that are not given are absent (null)."""
    kinds = {"parts": PARTS}
    return F.struct(*[given.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in ITEM_FIELDS])


def history_items(history: DataFrame) -> DataFrame:
    """Chat rows to request items.  An assistant row with tool calls gives
    one function_call item per call, then one message item if its text is
    non-empty; an assistant row without calls always gives a message item; a
    message's text is one ``output_text`` part.  Tool rows give
    function_call_output items with ``output``; user items have a role and plain
    ``content`` and no type.  A message keeps the id it has; one without gets an
    id from (conv_id, turn) instead of a random UUID, so re-runs agree.

    ``history``: conv_id, turn, role, content, tool_calls
    array<struct<id,name,arguments>>, tool_call_id, message_id.
    """
    made_id = F.concat(F.lit("msg-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    calls = F.transform(F.coalesce(F.col("tool_calls"), F.array().cast("array<struct<id:string,name:string,arguments:string>>")),
                        lambda c: _item(type=F.lit("function_call"), id=c["id"], call_id=c["id"], name=c["name"], arguments=c["arguments"]))
    part = F.array(F.struct(F.lit("output_text").alias("type"), F.col("content").alias("text")))
    msg = F.array(_item(type=F.lit("message"), role=F.lit("assistant"), id=F.coalesce(F.col("message_id"), made_id), parts=part))
    has_calls = F.size(F.coalesce(F.col("tool_calls"), F.array())) > 0
    assistant = (F.when(has_calls & (F.coalesce(F.col("content"), F.lit("")) != ""), F.concat(calls, msg))
                 .when(has_calls, calls).otherwise(msg))
    user = F.array(_item(role=F.lit("user"), content=F.col("content")))
    tool = F.array(_item(type=F.lit("function_call_output"), call_id=F.col("tool_call_id"), output=F.col("content")))
    none = F.filter(user, lambda x: F.lit(False))
    items = F.when(F.col("role") == "user", user).when(F.col("role") == "assistant", assistant).when(F.col("role") == "tool", tool).otherwise(none)
    return (history.select("conv_id", "turn", F.posexplode(items).alias("item_seq", "item"))
            .select("conv_id", "turn", "item_seq", "item.*"))


def item_json() -> Column:
    """The request item as JSON text, its fields in the order they are sent."""
    def fields(*names):
        return F.to_json(F.struct(*[F.col(n).alias("content" if n == "parts" else n) for n in names]))

    return (F.when(F.col("type") == "function_call", fields("type", "id", "call_id", "name", "arguments"))
            .when(F.col("type") == "message", fields("type", "id", "parts", "role"))
            .when(F.col("type") == "function_call_output", fields("type", "call_id", "output"))
            .otherwise(fields("role", "content")))


def history_from_conversations(conversations: DataFrame) -> DataFrame:
    """Chat history rows from logged turns: the first line of an assistant
    turn is its text, further lines are tool calls; system turns are tool
    results."""
    lines = F.split("text", "\n")
    calls = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x, i: F.struct(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"), (i + 1).cast("string")).alias("id"),
        F.lit("tool").alias("name"), x.alias("arguments")))
    role = F.when(F.col("role") == "system", F.lit("tool")).otherwise(F.col("role"))
    return conversations.select(
        "conv_id", "turn", role.alias("role"),
        F.when(F.col("role") == "assistant", F.element_at(lines, 1)).otherwise(F.col("text")).alias("content"),
        F.when(F.col("role") == "assistant", calls).alias("tool_calls"),
        F.when(F.col("role") == "system",
               F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")))
        .alias("tool_call_id"),
        # some messages were logged with an id
        F.when((F.col("conv_id") + F.col("turn")) % 3 == 0, F.concat(F.lit("m"), F.col("conv_id").cast("string"), F.lit("."),
                                                                    F.col("turn").cast("string"))).alias("message_id"),
    )


# ---- X7: structured content -> text ----------------------------------------

def text_parts_joined(parts: Column) -> Column:
    """Keep only parts of type 'text' and join their text."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"),
                                    lambda p: F.coalesce(p["text"], F.lit(""))), "")


def alternating_parts(text: Column) -> Column:
    """Content parts from a text: its lines, typed 'text' and 'image_url' in turn."""
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(
        F.when(i % 2 == 0, F.lit("text")).otherwise(F.lit("image_url")).alias("type"), x.alias("text")))


# ---- X8: feedback rows -----------------------------------------------------

def feedback_rows(ratings: DataFrame, request_id: str = "request_id", rating: str = "rating",
                  source: str | None = None) -> DataFrame:
    """``source`` names a column with who gave the rating (default: none).
    Rating 1 -> positive, any other value -> negative, NULL -> an empty
    assessment list; assessments serialised as JSON text (nulls kept)."""
    r = F.col(rating)
    label = F.when(r == 1, F.lit(RATING_POSITIVE)).otherwise(F.lit(RATING_NEGATIVE))
    who = F.col(source).cast("string") if source else F.lit(None).cast("string")
    one = F.array(F.struct(F.struct(F.struct(label.alias("value")).alias("answer_correct")).alias("ratings"),
                           F.lit(None).cast("string").alias("free_text_comment")))
    return ratings.select(
        F.col(request_id).alias("request_id"),
        F.when(r.isNotNull(), label).alias("rating_string"),
        F.when(r.isNull(), F.lit("[]")).otherwise(F.to_json(one, {"ignoreNullFields": "false"}))
        .alias("text_assessments"),
        F.lit("[]").alias("retrieval_assessments"),
        who.alias("source"),
    )


# ---- X9 / X10: name rules ----------------------------------------------------

def name_report(names: DataFrame, col: str = "name") -> DataFrame:
    """Normalised names with how many distinct raw names map to each; a
    normalised name with more than one raw name is a collision."""
    n = names.select(F.col(col).alias("raw_name"), C.sanitize_name(col, DEFAULT_NAME).alias("normalized_name"))
    return n.groupBy("normalized_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("raw_name").alias("n_raw_names"),
    ).withColumn("collides", F.col("n_raw_names") > 1)


def source_names(paths: DataFrame, col: str = "path") -> DataFrame:
    """Source name per path (last component, space and '.' -> '_')."""
    return paths.withColumn("source_name", C.path_leaf_name(col))
