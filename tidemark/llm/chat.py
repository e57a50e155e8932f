"""Tool calls of conversations: linked, ordered, validated and serialised.

Everything is DataFrame and SQL functions; JSON is handled as variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

#: JSON type names of schemas, and what ``schema_of_variant`` says of such values.
JSON_TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$|^DECIMAL\\([0-9]+,0\\)$", "number": "^BIGINT$|^DECIMAL|^DOUBLE$|^FLOAT$",
    "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY", "null": "^VOID$"
}


def canonical(json: Column) -> Column:
    """JSON with sorted keys and without white space; null if it isn't JSON or repeats a key."""
    return F.to_json(F.try_parse_json(json))


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Return (key, errors) for calls of (key, tool, arguments): what their tools' schemas reject, sorted.

    ``schemas`` has a row for each argument of a tool: tool, argument, type
    (of ``JSON_TYPES``), required, least and most (bounds on a number, or on a
    string's length; null for none).  It is broadcast if Spark finds it small.
    """
    tools = schemas.select("tool").distinct().withColumn("known", F.lit(True))
    parsed = calls.join(tools, "tool", "left").withColumn("v", F.try_parse_json("arguments"))
    shape = F.coalesce(F.schema_of_variant("v"), F.lit("none"))
    base = parsed.select(
        "key", "tool", "v",
        F.when(F.col("known").isNull(), "unknown tool").when(F.col("v").isNull(), "not JSON").when(
            ~shape.startswith("OBJECT"), "not an object"
        ).alias("error")
    )
    whole = base.where("error is not null").select("key", "error")
    sound = base.where("error is null").select("key", "tool", F.map_keys(F.from_json(F.to_json("v"), "map<string,string>")).alias("names"), "v")
    wanted = _given(sound, schemas)
    fits = F.lit(False)
    for name, pattern in JSON_TYPES.items():
        fits = fits | ((F.col("type") == name) & F.col("kind").rlike(pattern))
    size = F.when(F.col("type") == "string", F.length("plain").cast("double")).otherwise(F.expr("try_cast(plain as double)"))
    error = (
        F.when(~F.col("given") & F.col("required"), F.concat(F.lit("missing "), "argument"))
        .when(~F.col("given"), None)
        .when(~fits, F.concat("argument", F.lit(" isn't "), "type"))
        .when((size < F.col("least")) | (size > F.col("most")), F.concat("argument", F.lit(" out of bounds")))
    )
    own = wanted.select("key", error.alias("error")).where("error is not null")
    extra = sound.select("key", "tool", F.explode("names").alias("argument")).join(
        schemas.select("tool", "argument"), ["tool", "argument"], "left_anti"
    ).select("key", F.concat(F.lit("unknown "), "argument").alias("error"))
    found = whole.union(own).union(extra)
    return found.groupBy("key").agg(F.sort_array(F.collect_set("error")).alias("errors"))


def _given(sound: DataFrame, schemas: DataFrame) -> DataFrame:
    """A row for each call and argument of its schema: whether given, its kind and plain value."""
    fields = F.from_json(F.to_json("v"), "map<string,variant>")
    each = sound.join(schemas, "tool").withColumn("x", fields[F.col("argument")])
    return each.select(
        "key", "argument", "required", "type", "least", "most", F.array_contains("names", F.col("argument")).alias("given"),
        F.coalesce(F.schema_of_variant("x"), F.lit("VOID")).alias("kind"),
        F.expr("try_variant_get(x, '$', 'string')").alias("plain")
    )


def call_levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """Return (key, level): 0 for a call without a parent here, else one more than the parent's.

    Pointers are doubled, so a chain of n calls takes log2(n) rounds.  Calls on
    or below a cycle get a null level.
    """
    ids = calls.select(F.col("key").alias("up"), F.lit(True).alias("there"))
    at = scratch.keep(
        calls.select("key", F.col("parent").alias("up")).join(ids, "up", "left").select(
            "key", F.when(F.col("there"), F.col("up")).alias("up"),
            F.when(F.col("there"), 1).otherwise(0).cast("long").alias("level")
        ),
        "levels"
    )
    n = at.count()
    for k in range(1, max(1, n).bit_length() + 2):
        if not at.where("up is not null").limit(1).count():
            break
        step = at.select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        at = scratch.keep(
            at.join(step, "up", "left").select(
                "key", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")
            ),
            f"levels{k}"
        )
    return at.select("key", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Link tool calls with their results, one row for each call and each orphan result identifier.

    ``calls``: conv_id, call_id, parent_id (the call whose result it builds on,
    or null), tool, arguments (JSON).  ``results``: conv_id, call_id, turn,
    content.  ``schemas``: see ``argument_errors``.

    Returns conv_id, call_id, tool, level (place in the topological order, ties
    by call_id), status (``linked``, ``missing`` without a result, ``orphan``
    without a call, ``cycle``), n_results, valid, errors (joined by ``; ``) and
    record, the canonical JSON of call and first result.

    The first result by turn, then content, counts.  Of calls that repeat a
    conversation and identifier the one with the smallest tool, arguments and
    parent counts.  Rows with a null conversation or identifier can't be linked
    and come back as ``missing`` or ``orphan``, one for each different row.
    Other columns are ignored; empty tables give empty results.
    """
    scratch = Scratch(calls.sparkSession, "chat")
    key = lambda a, b: F.to_json(F.struct(F.col(a).cast("string").alias("c"), F.col(b).cast("string").alias("i")))
    lone = calls.where("conv_id is null or call_id is null").select("conv_id", "call_id", "tool", "arguments").distinct()
    first = F.min(F.struct("tool", "arguments", "parent_id")).alias("m")
    one = calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(first).select(
        "conv_id", "call_id", key("conv_id", "call_id").alias("key"), "m.tool", "m.arguments",
        F.when(F.col("m.parent_id").isNotNull(), key("conv_id", "m.parent_id")).alias("parent")
    )
    one = scratch.keep(one, "calls")
    told = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct(F.col("turn"), F.col("content"))).alias("r"), F.count("*").alias("n_results")
    )
    told = scratch.keep(
        told.select(
            key("conv_id", "call_id").alias("key"), "conv_id", "call_id", F.col("r.content").alias("content"),
            F.lit(True).alias("has"), "n_results"
        ),
        "results"
    )
    linked = one.join(told.drop("conv_id", "call_id"), "key", "left").join(call_levels(one, scratch), "key").join(
        argument_errors(one.select("key", "tool", "arguments"), schemas), "key", "left"
    )
    errors = F.coalesce(F.array_join("errors", "; "), F.lit(""))
    parts = [
        F.concat(F.lit('"arguments":'), F.coalesce(canonical(F.col("arguments")), quoted("arguments"))),
        F.concat(F.lit('"id":'), quoted("call_id")),
        F.when(F.col("has"), F.concat(F.lit('"result":'), quoted("content"))),
        F.concat(F.lit('"tool":'), quoted("tool")),
    ]
    rows = linked.select(
        "conv_id", "call_id", "tool", "level",
        F.when(F.col("level").isNull(), "cycle").when(F.col("has"), "linked").otherwise("missing").alias("status"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"), (errors == "").alias("valid"), errors.alias("errors"),
        F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("record"),
    )
    orphans = told.join(one.select("key"), "key", "left_anti").select("conv_id", "call_id", "n_results", "content")
    apart = results.where("conv_id is null or call_id is null").select("conv_id", "call_id", "content").groupBy("conv_id", "call_id", "content").agg(F.count("*").alias("n_results")).select(
        "conv_id", "call_id", "n_results", "content"
    )
    no = lambda t: F.lit(None).cast(t)
    orphans = orphans.union(apart).select(
        "conv_id", "call_id", no("string").alias("tool"), no("long").alias("level"), F.lit("orphan").alias("status"), "n_results",
        F.lit(False).alias("valid"), F.lit("no call").alias("errors"),
        F.concat(F.lit('{"id":'), quoted("call_id"), F.lit(',"result":'), quoted("content"), F.lit("}")).alias("record")
    )
    lone = lone.select(
        "conv_id", "call_id", "tool", F.lit(0).cast("long").alias("level"), F.lit("missing").alias("status"),
        F.lit(0).cast("long").alias("n_results"), F.lit(False).alias("valid"), F.lit("no identifier").alias("errors"),
        F.concat(
            F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), quoted("arguments")), F.lit(',"id":'),
            quoted("call_id"), F.lit(',"tool":'), quoted("tool"), F.lit("}")
        ).alias("record")
    )
    return scratch.result(rows.unionByName(orphans).unionByName(lone))


def quoted(name: str) -> Column:
    """A column as a JSON string, or ``null``."""
    wrapped = f"to_json(named_struct('s', cast({name} as string)))"
    return F.when(F.col(name).isNull(), "null").otherwise(F.expr(f"substring({wrapped}, 6, length({wrapped}) - 6)"))


def messages_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read plain conversations (conv_id, turn, role, text) as tool calls and results.

    A user's message calls the tool ``respond`` with its text and turn, a system
    message ``configure``; an assistant's message is the result of the call one
    turn before it.  A call builds on the one two turns earlier, or on turn 0.
    """
    name = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    turn = F.col("turn")
    arguments = F.to_json(F.struct(F.col("text").alias("text"), turn.alias("turn")))
    calls = messages.where("role in ('user', 'system')").select(
        "conv_id", name(turn).alias("call_id"), F.when(turn > 0, name(F.greatest(F.lit(0), turn - 2))).alias("parent_id"),
        F.when(F.col("role") == "user", "respond").otherwise("configure").alias("tool"), arguments.alias("arguments")
    )
    results = messages.where("role = 'assistant'").select("conv_id", name(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


#: What the two tools of plain conversations accept.
CONVERSATION_SCHEMAS = [
    ("respond", "text", "string", True, 1.0, 300.0),
    ("respond", "turn", "integer", True, 0.0, None),
    ("configure", "text", "string", True, 1.0, None),
    ("configure", "turn", "integer", True, 0.0, 0.0),
]
SCHEMA_COLUMNS = "tool string, argument string, type string, required boolean, least double, most double"
