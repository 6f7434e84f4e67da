"""Tool-call linking for chat data, in DataFrame functions alone.

Calls and results meet by hash join on the call's identifier. A call may name
the call whose result it builds on (its parent); its depth in that forest, found
by pointer doubling in as many rounds as the depth has binary digits, is its place in a
topological order. Arguments are parsed as JSON and held against the tool's
schema; every linked call is written as canonical JSON: sorted keys, no blanks, and one text for each number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import cut

#: JSON type of a schema -> test on the type that Spark's variant reports.
TYPES = {
    "string": lambda t: t == "STRING",
    "boolean": lambda t: t == "BOOLEAN",
    "integer": lambda t: (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL"),  # and a value without a fraction
    "number": lambda t: t.isin("BIGINT", "DOUBLE") | t.startswith("DECIMAL"),
    "array": lambda t: t.startswith("ARRAY"),
    "object": lambda t: t.startswith("OBJECT"),
}


def _number(t: Column) -> Column:
    """A JSON number as plain digits, no zeros at either end, no minus zero; beyond 40 digits as 1.5e41 or 1.5e-41."""
    sign, digits = F.when(t.startswith("-"), "-").otherwise(""), lambda k: F.regexp_extract(t, r"^-?(\d+)(?:\.(\d+))?(?:[eE]\+?(-?\d+))?$", k)
    whole, exponent = digits(1), F.coalesce(F.nullif(digits(3), F.lit("")), F.lit("0")).cast("int")
    both = F.concat(whole, digits(2))
    led = F.length(both) - F.length(F.ltrim(both, F.lit("0")))
    m = F.rtrim(F.ltrim(both, F.lit("0")), F.lit("0"))
    n = F.length(m)
    point = F.length(whole) + exponent - led  # digits of m before the point
    zeros = lambda k: F.repeat(F.lit("0"), k.cast("int"))
    text = (F.when(point.between(-39, 0), F.concat(F.lit("0."), zeros(-point), m))
            .when((point > 0) & (point <= 41) & (n <= point), F.concat(m, zeros(point - n)))
            .when((point > 0) & (point <= 41), F.concat(m.substr(F.lit(1), point), F.lit("."), m.substr(point + 1, n)))
            .otherwise(F.concat(m.substr(1, 1), F.when(n > 1, F.concat(F.lit("."), m.substr(F.lit(2), n))).otherwise(""), F.lit("e"), (point - 1).cast("string"))))
    return F.when(m == "", "0").otherwise(F.concat(sign, text))


def canonical(parsed: Column) -> Column:
    """A variant as JSON text: keys sorted (as the variant holds them), no blanks, each number in the one form of its value.

    Strings are told from the rest by splitting at quotes, after escaped backslashes and
    quotes have given way to control characters, which JSON text cannot hold as such."""
    text = F.replace(F.replace(F.to_json(parsed), F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    number = lambda x: F.when(x.rlike("^-?[0-9]"), _number(x)).otherwise(x)
    outside = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"(-?[0-9][-+.0-9eE]*|[^-0-9]+)"), F.lit(1)), number), "")
    parts = F.transform(F.split(text, '"', -1), lambda x, i: F.when(i % 2 == 0, outside(x)).otherwise(x))
    return F.replace(F.replace(F.array_join(parts, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, parent_id), ids distinct -> call_id, depth: 0 without a known parent, else one more than the parent's.

    Null for calls on a cycle, or above one. Doubling: each round joins every
    unfinished call's pointer with the state of the call that it points to."""
    ids = calls.select(F.col("call_id").alias("known"))
    state = cut(calls.join(ids, calls["parent_id"] == ids["known"], "left")
                .select("call_id", F.col("known").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    n = state.count()
    for _ in range(n.bit_length() + 1):
        if state.where("up is not null").isEmpty():
            break
        to = state.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        moving = state.where("up is not null").join(to, "up").select("call_id", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        state = cut(state.where("up is null").unionByName(moving))
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def validity(name: Column, arguments: Column, schemas: dict) -> Column:
    """valid, malformed (no JSON object), unknown_tool or invalid (a parameter missing, of another type, or not in the schema).

    ``schemas``: tool -> {parameter: (type, required)}, a parameter of bounded size."""
    parsed = F.try_parse_json(arguments)
    out = F.lit("unknown_tool")
    for tool, parameters in schemas.items():
        tests = [F.size(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, parameters)).cast("array<string>"))) == 0]
        for p, (kind, required) in parameters.items():
            value = F.try_variant_get(parsed, f"$['{p}']", "variant")
            fits = TYPES[kind](F.schema_of_variant(value))
            if kind == "integer":  # 1.00 and 1e2 are integers too
                fits = fits & canonical(value).rlike("^-?[0-9]+$|e[0-9]+$")
            tests.append(F.coalesce(fits, F.lit(not required)))
        fits = reduce(lambda x, y: x & y, tests)
        out = F.when(name == tool, F.when(fits, "valid").otherwise("invalid")).otherwise(out)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.when(~F.coalesce(is_object, F.lit(False)), "malformed").otherwise(out)


def link(calls: DataFrame, results: DataFrame, schemas: dict, others: DataFrame | None = None) -> DataFrame:
    """Calls (conv_id, turn, call_id, name, arguments, parent_id) with their results (call_id, turn, content).

    One row per identifier, in the order (conv_id, depth, turn, call_id), in
    which a call never stands before what it builds on: n_calls and n_results with the
    identifier (of several the first by turn, then by content, is taken),
    depth, linked (linked, no_result, orphan_result), validity and json. Calls on
    a cycle have a null depth. Calls and results without an identifier cannot
    be linked: each is a row of its own (no_id). ``others`` (conv_id, turn, role, content): turns
    that are neither, a row each (not_a_call, the role in name, the content in json's result).
    Arguments that are a JSON object are written canonically; any other text (malformed, a key twice, no object) is kept
    as a JSON string. Null texts count as JSON null; empty tables give no rows. Other columns are not read."""
    fields = ["conv_id", "turn", "name", "arguments", "parent_id"]
    by_id = (calls.where("call_id is not null").groupBy("call_id")
             .agg(F.min(F.struct("turn", "name", "arguments", "parent_id", "conv_id")).alias("c"), F.count("*").alias("n_calls")))
    one = cut(by_id.select("call_id", "n_calls", *[F.col(f"c.{f}").alias(f) for f in fields]))
    got = (results.where("call_id is not null").groupBy(F.col("call_id").alias("result_id"))
           .agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")))
    placed = one.join(depths(one.select("call_id", "parent_id")), "call_id")
    both = (placed.join(got, placed["call_id"] == got["result_id"], "full")
            .select("conv_id", F.coalesce("turn", "r.turn").alias("turn"), F.coalesce("call_id", "result_id").alias("call_id"), "name", "arguments",
                    "parent_id", "depth", F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                    F.col("r.content").alias("content"),
                    F.when(F.col("result_id").isNull(), "no_result").when(F.col("n_calls").isNull(), "orphan_result").otherwise("linked").alias("linked")))
    lost = calls.where("call_id is null").select(
        "conv_id", "turn", "call_id", "name", "arguments", "parent_id", F.lit(0).cast("long").alias("depth"), F.lit(1).cast("long").alias("n_calls"),
        F.lit(0).cast("long").alias("n_results"), F.lit(None).cast("string").alias("content"), F.lit("no_id").alias("linked"))
    stray = results.where("call_id is null").select(
        F.lit(None).cast(calls.schema["conv_id"].dataType).alias("conv_id"), "turn", "call_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_calls"), F.lit(1).cast("long").alias("n_results"), "content", F.lit("no_id").alias("linked"))
    rows = both.unionByName(lost).unionByName(stray)
    if others is not None:
        none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
        rows = rows.unionByName(others.select(
            "conv_id", "turn", none.alias("call_id"), F.col("role").alias("name"), none.alias("arguments"), none.alias("parent_id"),
            F.lit(None).cast("long").alias("depth"), zero.alias("n_calls"), zero.alias("n_results"), "content", F.lit("not_a_call").alias("linked")))
    rows = rows.withColumn("validity", F.when(F.col("n_calls") == 0, F.lit(None).cast("string")).otherwise(validity(F.col("name"), F.col("arguments"), schemas)))
    rest = F.to_json(F.struct("call_id", "depth", "linked", "name", F.col("content").alias("result"), "validity"), {"ignoreNullFields": "false"})
    parsed, quoted = F.try_parse_json("arguments"), F.to_json(F.struct(F.col("arguments").alias("a")))
    arguments = (F.when(F.schema_of_variant(parsed).startswith("OBJECT"), canonical(parsed))
                 .when(F.col("arguments").isNotNull(), quoted.substr(F.lit(6), F.length(quoted) - 6)).otherwise("null"))
    json = F.concat(F.lit('{"arguments":'), arguments, F.lit(","), F.substring(rest, 2, 2_147_483_647))
    return (rows.select("conv_id", "depth", "turn", "call_id", "name", "parent_id", "n_calls", "n_results", "linked", "validity", json.alias("json"))
            .orderBy("conv_id", "depth", "turn", "call_id"))


#: The tool that a chat without tools of its own is read as calling: an answer to a prompt.
ANSWER = {"answer": {"prompt": ("string", True), "n_chars": ("integer", True)}}


def as_calls(conversations: DataFrame) -> tuple:
    """(calls, results) of a table (conv_id, turn, role, text): a user's turn calls ``answer``, the assistant's next turn is the result.

    The identifier is conv_id:turn of the user; a call builds on the user's turn two before. Turns
    without a conv_id or turn have no identifier; a null text is a null prompt or content. Turns of other roles are
    in neither: see ``other_turns``. Repeated rows are calls of one identifier; other columns are not read."""
    at = lambda back: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), (F.col("turn") - back).cast("string"))
    named = lambda c: F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), c)
    prompt = F.to_json(F.struct(F.length("text").alias("n_chars"), F.col("text").alias("prompt")), {"ignoreNullFields": "false"})
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", named(at(0)).alias("call_id"), F.lit("answer").alias("name"), prompt.alias("arguments"), named(at(2)).alias("parent_id"))
    results = conversations.where("role = 'assistant'").select(named(at(1)).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content) of the turns that ``as_calls`` doesn't read: system turns, null and unknown roles."""
    role = F.coalesce("role", F.lit(""))
    return conversations.where(~role.isin("user", "assistant")).select("conv_id", "turn", "role", F.col("text").alias("content"))
