"""Tool-call linking of chat transcripts, with DataFrame functions only.

Calls and results meet in a hash join on their identifier.  Calls form chains
by the call whose result they need; their depth, which orders them
topologically, is found by pointer doubling, so that a conversation of any
length takes a logarithmic number of joins and is never gathered in one task.
Arguments are checked field by field against a schema table and written as
canonical JSON (sorted keys, no blanks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

#: A schema table: one row a field of a tool.
SCHEMA_COLUMNS = "name string, field string, kind string, required boolean, least double, most double"


def call_depths(calls: DataFrame, ws: Workspace) -> DataFrame:
    """``call_id, depth`` for calls ``call_id, parent_id``; -1 on or behind a cycle.

    A parent that is no call counts as none.
    """
    known = calls.select(F.col("call_id").alias("parent_id")).distinct()
    start = calls.groupBy("call_id").agg(F.min("parent_id").alias("parent_id"))
    roots = start.join(known, "parent_id", "left_semi").select("call_id", F.col("parent_id").alias("jump"), F.lit(1).cast("long").alias("depth"))
    state = ws.save(roots.unionByName(start.join(known, "parent_id", "left_anti").select("call_id", F.lit(None).cast("string").alias("jump"), F.lit(0).cast("long").alias("depth"))), "depth")
    left = None
    while True:
        open_now = state.filter("jump IS NOT NULL").count()
        if not open_now or open_now == left:
            break
        left = open_now
        step = state.select(F.col("call_id").alias("jump"), F.col("jump").alias("next"), F.col("depth").alias("more"))
        going = state.filter("jump IS NOT NULL").join(step, "jump", "left").select("call_id", F.col("next").alias("jump"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        after = ws.save(state.filter("jump IS NULL").unionByName(going), "depth")
        ws.drop(state)
        state = after
    return state.select("call_id", F.when(F.col("jump").isNull(), F.col("depth")).otherwise(-1).alias("depth"))


def check_arguments(calls: DataFrame, schemas: DataFrame, key: str = "call_id") -> DataFrame:
    """``key, errors`` for calls ``key, name, arguments`` (JSON text).

    errors lists, in order, ``not json``, ``unknown tool``, and for each
    field of the schema ``field: missing``, ``: kind`` or ``: range``; a field
    whose name holds both kinds of quotes is ``: name``.  Kinds are
    string, integer, number and boolean.  The schema table is joined by the
    tool's name; it is not assumed to be small.
    """
    parsed = calls.select(key, "name", F.try_parse_json("arguments").alias("v"))
    rows = parsed.join(schemas, "name", "left")
    quote = F.when(F.contains("field", F.lit("'")), F.lit('"')).otherwise(F.lit("'"))
    odd = F.contains("field", F.lit("'")) & F.contains("field", F.lit('"'))
    path = F.when(~odd, F.concat(F.lit("$["), quote, F.col("field"), quote, F.lit("]")))
    kind = F.schema_of_variant(F.try_variant_get("v", path, "variant"))
    number = F.try_variant_get("v", path, "double")
    text = F.try_variant_get("v", path, "string")
    size = F.when(F.col("kind") == "string", F.length(text).cast("double")).otherwise(number)
    fits = (
        F.when(F.col("kind") == "string", kind == "STRING")
        .when(F.col("kind") == "integer", kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"))
        .when(F.col("kind") == "number", kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"))
        .otherwise(kind == "BOOLEAN")
    )
    wrong = (
        F.when(F.col("v").isNull(), F.lit("not json"))
        .when(F.col("field").isNull(), F.lit("unknown tool"))
        .when(odd, F.concat("field", F.lit(": name")))
        .when(kind.isNull() | (kind == "VOID"), F.when(F.col("required"), F.concat("field", F.lit(": missing"))))
        .when(~fits, F.concat("field", F.lit(": kind")))
        .when((size < F.col("least")) | (size > F.col("most")), F.concat("field", F.lit(": range")))
    )
    return rows.select(key, wrong.alias("wrong")).groupBy(key).agg(F.array_sort(F.collect_set("wrong")).alias("errors"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame, *, workspace: Workspace | None = None) -> DataFrame:
    """One row a call, and one a result without a call, as canonical JSON.

    ``calls``: conv_id, turn, call_id, parent_id, name, arguments (JSON text);
    ``results``: conv_id, turn, call_id, content.  Output: conv_id, turn,
    call_id, kind (``call`` or ``orphan``), depth, n_results, result_turn,
    valid, errors and json.  Sorting by conv_id, depth, turn, call_id gives a
    topological order of each conversation.

    Defined cases: identifiers count within their conversation (a null conv_id
    is one); repeated calls stay rows of their own, exact copies once, and all
    link to the identifier's result, the least by turn and content; n_results
    counts all; depth follows the least parent of an identifier; a null
    identifier links with nothing (each distinct such call stays, with depth 0;
    such results are no rows); null arguments are ``not json``; calls on a
    cycle have depth -1; empty tables give no rows; other columns are ignored.
    Texts beyond the size limit of Spark's variants are ``not json``.
    """
    ws = workspace or Workspace(calls.sparkSession, "chat")
    within = lambda c: F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), F.lit("\0"), F.col(c))
    c = calls.select("conv_id", "turn", "call_id", "parent_id", "name", "arguments")
    named = ws.save(c.filter("call_id IS NOT NULL").distinct().withColumn("key", within("call_id")).withColumn("row", F.monotonically_increasing_id()), "calls")
    depths = call_depths(named.select(F.col("key").alias("call_id"), within("parent_id").alias("parent_id")), ws).withColumnRenamed("call_id", "key")
    found = results.filter("call_id IS NOT NULL").withColumn("key", within("call_id")).groupBy("key").agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content", "conv_id", "call_id")).alias("r"))
    errors = check_arguments(named, schemas, "row")
    linked = named.join(errors, "row").join(depths, "key").join(found, "key", "left")
    linked = linked.select("conv_id", "turn", "call_id", F.lit("call").alias("kind"), "depth", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), F.col("r.turn").alias("result_turn"), "errors", "name", "arguments", F.col("r.content").alias("content"))
    orphan = found.join(named.select("key"), "key", "left_anti").select("r.conv_id", F.col("r.turn").alias("turn"), "r.call_id", F.lit("orphan").alias("kind"), F.lit(0).cast("long").alias("depth"), F.col("n_results"), F.col("r.turn").alias("result_turn"), F.array(F.lit("no call")).alias("errors"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.col("r.content").alias("content"))
    nameless = c.filter("call_id IS NULL").distinct().select("conv_id", "turn", "call_id", F.lit("call").alias("kind"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_results"), F.lit(None).cast(results.schema["turn"].dataType).alias("result_turn"), F.array(F.lit("no id")).alias("errors"), "name", "arguments", F.lit(None).cast("string").alias("content"))
    rows = linked.unionByName(orphan).unionByName(nameless)
    given = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.lit("null"))
    quoted = lambda x: F.coalesce(F.expr(f"substring(to_json(array({x})), 2, length(to_json(array({x}))) - 2)"), F.lit("null"))
    body = F.concat(F.lit('{"arguments":'), given, F.lit(',"id":'), quoted("call_id"), F.lit(',"name":'), quoted("name"), F.lit(',"result":'), quoted("content"), F.lit("}"))
    return rows.select("conv_id", "turn", "call_id", "kind", "depth", "n_results", "result_turn", (F.size("errors") == 0).alias("valid"), F.array_join("errors", "; ").alias("errors"), body.alias("json"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that plain transcripts hold.

    A user turn is a call of the tool ``reply`` with its text and role as
    arguments, a system turn a call of ``setup``; a turn of any other role, null
    too, is the result of the turn before it.  A call needs the result before
    it, so its parent is the call two turns back.  A null text is an empty one;
    a turn without conversation or number has no identifier; repeated turns are
    repeated calls or results; other columns are ignored.
    """
    ident = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit(":"), t.cast("string"))
    t = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    asking = F.coalesce(F.col("role").isin("user", "system"), F.lit(False))
    asks = t.filter(asking)
    arguments = F.to_json(F.struct(F.col("role"), F.col("text"), F.col("turn")))
    calls = asks.select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), ident(F.col("turn") - 2).alias("parent_id"), F.when(F.col("role") == "user", "reply").otherwise("setup").alias("name"), arguments.alias("arguments"))
    results = t.filter(~asking).select("conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
