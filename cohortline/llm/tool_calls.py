"""Chat formatting: tool calls linked to their results, ordered, checked and written as canonical JSON.

Native Spark expressions only. Calls and results are read from messages that are
JSON objects (``tool_calls`` of an assistant, ``tool_call_id`` of a tool), joined
by conversation and identifier, and put in topological order. Arguments are held
against a schema for each tool, and every record becomes JSON with sorted keys.
Nothing gathers a conversation: a record is a row with its place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import settle, table
from cohortline.plans.ordering import row_index

# Parameters of a tool: name, JSON type, and whether it must be given.
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]

# The tool that a turn of the user stands for, see ``exchanges``.
REPLY: Schemas = {"reply": {"prompt": ("string", True), "turn": ("integer", True)}}

# What a variant calls the JSON types.
_KINDS = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "null": "^VOID$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _parsed(text: Column) -> Column:
    return F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))


def read_calls(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, place, call_id, name, arguments, needs`` of each call in the messages.

    ``arguments`` is JSON text, whether it was given as an object or as a string;
    ``needs`` lists the calls that must come before (key ``after``).
    """
    told = messages.filter("role = 'assistant'").select("conv_id", "turn", _parsed(F.col("text")).alias("message"))
    call = F.try_variant_get("message", "$.tool_calls", "array<variant>")
    one = told.select("conv_id", "turn", F.posexplode(call).alias("place", "call"))

    def part(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("call", path, kind)

    return one.select(
        "conv_id",
        "turn",
        "place",
        part("$.id").alias("call_id"),
        F.coalesce(part("$.name"), part("$.function.name")).alias("name"),
        F.coalesce(part("$.arguments"), part("$.function.arguments")).alias("arguments"),
        F.coalesce(part("$.after", "array<string>"), F.array().cast("array<string>")).alias("needs"),
    )


def read_results(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, call_id, content`` of each result in the messages."""
    told = messages.filter("role = 'tool'").select("conv_id", "turn", _parsed(F.col("text")).alias("message"))
    found = told.select(
        "conv_id",
        "turn",
        F.try_variant_get("message", "$.tool_call_id", "string").alias("call_id"),
        F.try_variant_get("message", "$.content", "string").alias("content"),
    )
    return found.filter("call_id is not null")


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level``: the longest chain of needed calls before each call.

    Needs of calls that do not exist, and of calls without a conversation, are
    ignored; calls on a cycle, or behind one, have no level.
    """
    nowhere = calls.select("conv_id", "call_id", "needs", F.lit(0).alias("turn"), F.lit(0).alias("place"))
    return settled_calls(nowhere).drop("behind")


def settled_calls(calls: DataFrame) -> DataFrame:
    """``levels``, and ``behind``: the last ``(turn, place)`` among each call and all that it needs.

    Calls with one need are settled by pointer doubling, in rounds that grow with
    the logarithm of a chain. Calls with several needs are then settled level by
    level, so they alone add rounds, by their number on a path.
    """
    key = ["conv_id", "call_id"]
    nodes = settle(
        calls.filter("call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "place")).alias("behind"))
    )
    links = settle(
        calls.filter("call_id is not null and size(needs) > 0")
        .select(*key, F.explode("needs").alias("need")).distinct()
        .join(nodes.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"], "left_semi")
    )
    if links.isEmpty():
        return nodes.select(*key, F.lit(0).alias("level"), "behind")
    several = links.groupBy(*key).agg(F.count("*").alias("n"), F.min("need").alias("need"))
    # Calls that need one other: where they point to, how far it is, and the last place on the way to it.
    path = several.filter("n = 1").join(nodes, key).select(*key, "need", F.lit(1).alias("far"), "behind")
    path, done, before = settle(path), None, None
    while True:
        ahead = path.select("conv_id", F.col("call_id").alias("need"), F.col("need").alias("next"),
                            F.col("far").alias("more"), F.col("behind").alias("then"))
        jumped = settle(
            path.join(ahead, ["conv_id", "need"], "left").select(
                *key, F.coalesce("next", "need").alias("need"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                F.greatest("behind", F.coalesce("then", "behind")).alias("behind"), F.col("next").isNotNull().alias("open"),
            )
        )
        open_ = jumped.filter("open").count()
        # Each round ends at least one path while there is one to end; the rest are cycles.
        if open_ in (0, before):
            done = jumped.filter("not open").drop("open")
            break
        path, before = jumped.drop("open"), open_
    ends = links.select(*key).distinct()
    settled = settle(nodes.join(ends, key, "left_anti").select(*key, F.lit(0).alias("level"), "behind"))
    joins = several.filter("n > 1").select(*key)
    wanted = links.join(joins, key, "left_semi")
    # A need that was settled by its path stands for the call at the end of the path.
    over = done.select("conv_id", F.col("call_id").alias("need"), F.col("need").alias("end"), "far", F.col("behind").alias("then"))
    steps = settle(
        wanted.join(over, ["conv_id", "need"], "left")
        .select(*key, F.coalesce("end", "need").alias("need"), F.coalesce("far", F.lit(0)).alias("far"), "then")
    )
    while not steps.isEmpty():
        known = settled.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("known"), "level",
                               F.col("behind").alias("there"))
        state = steps.join(known, ["conv_id", "need"], "left").groupBy(*key).agg(
            F.count("*").alias("n"), F.count("known").alias("done"), F.max(F.col("level") + F.col("far") + 1).alias("level"),
            F.max(F.greatest("there", F.coalesce("then", "there"))).alias("needed"),
        )
        new = settle(
            state.filter("n = done").join(nodes, key)
            .select(*key, "level", F.greatest("behind", "needed").alias("behind"))
        )
        if new.isEmpty():
            break
        settled = settle(settled.unionByName(new))
        steps = settle(steps.join(new, key, "left_anti"))
    known = settled.select("conv_id", F.col("call_id").alias("need"), "level", F.col("behind").alias("there"))
    single = done.join(known, ["conv_id", "need"]).select(
        *key, (F.col("level") + F.col("far")).alias("level"), F.greatest("behind", "there").alias("behind")
    )
    every = settle(settled.unionByName(single))
    # Calls without a conversation are settled, though their nulls meet nothing here.
    rest = nodes.filter("conv_id is not null").join(every, key, "left_anti").select(
        *key, F.lit(None).cast("int").alias("level"), F.lit(None).cast(nodes.schema["behind"].dataType).alias("behind")
    )
    return every.unionByName(rest)


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted array of what is wrong with JSON arguments: unknown tool, missing, unknown or mistyped parameters."""
    values = F.from_json(arguments, "map<string,variant>")
    given = F.coalesce(F.map_keys(values), F.array().cast("array<string>"))
    wrong = F.array(F.lit("unknown tool"))
    for tool, parameters in schemas.items():
        checks = []
        for parameter, (kind, required) in sorted(parameters.items()):
            there = F.array_contains(given, parameter)
            typed = F.schema_of_variant(values[parameter]).rlike(_KINDS[kind])
            missing = F.lit(f"missing {parameter}") if required else F.lit(None)
            checks.append(F.when(~there, missing).when(~F.coalesce(typed, F.lit(False)), F.lit(f"type of {parameter}")))
        known = F.array(*[F.lit(p) for p in parameters]) if parameters else F.array().cast("array<string>")
        unknown = F.transform(F.array_except(given, known), lambda p: F.concat(F.lit("unknown "), p))
        every = F.concat(F.array_compact(F.array(*checks)) if checks else unknown, unknown if checks else F.array())
        wrong = F.when(name == tool, every).otherwise(wrong)
    return F.sort_array(F.when(F.try_parse_json(arguments).isNull(), F.array(F.lit("not JSON"))).otherwise(wrong))


def link_calls(calls: DataFrame, results: DataFrame, messages: DataFrame, schemas: Schemas) -> DataFrame:
    """Records of all calls, of results without a call, and of other messages.

    ``conv_id, turn, seq, kind, call_id, linked, errors, record``: ``kind`` is
    call, orphan or message, ``seq`` the place in the conversation from zero and
    ``record`` canonical JSON. A conversation keeps its own order where needed
    calls come first; a call that stands before what it needs goes behind the last
    of it, and calls that meet there are ordered by level. Calls on a cycle come
    last, with an error. Of several results of one call the earliest counts;
    calls that share an identifier share its result. Null ids are a conversation
    of their own; null texts are null in the record.
    """
    settled = settled_calls(calls)
    key = ["conv_id", "call_id"]
    first = results.groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("result")).select(
        F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), "result"
    )
    ranked = settled.select(F.col("conv_id").alias("l_conv"), F.col("call_id").alias("l_call"), "level", "behind")
    same_result = F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call"))
    same_level = F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("call_id") == F.col("l_call"))
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    made = (
        calls.join(first, same_result, "left")
        .join(ranked, same_level, "left")
        .withColumn("cyclic", F.col("call_id").isNotNull() & F.col("level").isNull())
        .withColumn("errors", F.when(F.col("cyclic"), F.array_append(errors, F.lit("cycle"))).otherwise(errors))
    )
    records = made.select(
        "conv_id",
        "turn",
        "place",
        F.lit("call").alias("kind"),
        "call_id",
        F.col("result").isNotNull().alias("linked"),
        F.array_join("errors", "; ").alias("errors"),
        F.coalesce("level", F.when(F.col("cyclic"), F.lit((1 << 31) - 1)), F.lit(0)).alias("level"),
        "cyclic",
        F.greatest(F.struct("turn", "place"), F.coalesce("behind", F.struct("turn", "place"))).alias("at"),
        _json(
            F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), "name").alias("call"),
            F.when(F.col("result").isNotNull(), F.struct("result.content", "result.turn")).alias("result"),
            "turn",
        ).alias("record"),
    )
    named = calls.select(F.col("conv_id").alias("c_conv"), F.col("call_id").alias("c_call")).distinct()
    without = F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("call_id") == F.col("c_call"))
    orphans = results.join(named, without, "left_anti").select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("orphan").alias("kind"), "call_id",
        F.lit(False).alias("linked"), F.lit("no call").alias("errors"), F.lit(0).alias("level"),
        _json(F.lit(None).cast("string").alias("call"), F.struct("content", "turn").alias("result"), "turn").alias("record"),
    )
    plain = messages.select(
        "conv_id", "turn", F.lit(-1).alias("place"), F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"), F.lit(False).alias("linked"), F.lit("").alias("errors"),
        F.lit(0).alias("level"), _json(F.col("text").alias("content"), "role", "turn").alias("record"),
    )
    here = F.struct("turn", "place").alias("at")
    others = orphans.unionByName(plain).select("*", F.lit(False).alias("cyclic"), here)
    every = records.unionByName(others).select("*", F.col("at.turn").alias("at_turn"), F.col("at.place").alias("at_place"))
    # What a call needs, and then its level, decide where it stands.
    order = ["cyclic", "at_turn", "at_place", "kind", "level", "turn", "place", "record"]
    indexed = row_index(every.drop("at"), ["conv_id"], order, "seq")
    return indexed.select("conv_id", "turn", "seq", "kind", "call_id", "linked", "errors", "record")


def format_chats(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """``link_calls`` over a table ``conv_id, turn, role, text``; other columns are ignored."""
    told = messages.select("conv_id", "turn", "role", "text")
    parsed = _parsed(F.col("text"))
    has_calls = (F.col("role") == "assistant") & F.try_variant_get(parsed, "$.tool_calls", "array<variant>").isNotNull()
    is_result = (F.col("role") == "tool") & F.try_variant_get(parsed, "$.tool_call_id", "string").isNotNull()
    plain = told.filter(~F.coalesce(has_calls | is_result, F.lit(False)))
    return link_calls(read_calls(told), read_results(told), plain, schemas)


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A chat without tools as calls, results and other messages.

    A turn of the user is a call of ``reply`` with its text as prompt, the turn of
    the assistant behind it the result; other turns stay messages. A call needs
    the one whose result is the turn before it.
    """
    called = F.concat(F.lit("reply-"), F.col("turn").cast("string"))
    calls = messages.filter("role = 'user'").select(
        "conv_id", "turn", F.lit(0).alias("place"), called.alias("call_id"), F.lit("reply").alias("name"),
        _json(F.col("text").alias("prompt"), "turn").alias("arguments"),
        F.array(F.concat(F.lit("reply-"), (F.col("turn") - 2).cast("string"))).alias("needs"),
    )
    before = F.concat(F.lit("reply-"), (F.col("turn") - 1).cast("string"))
    results = messages.filter("role = 'assistant'").select(
        "conv_id", "turn", before.alias("call_id"), F.col("text").alias("content")
    )
    other = messages.filter("coalesce(role not in ('user', 'assistant'), true)")
    return calls, results, other


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations")
    return link_calls(*exchanges(messages), REPLY)


SQL = r"""
WITH call AS (
    SELECT conv_id, turn, text, 'reply-' || turn AS call_id FROM conversations WHERE role = 'user'
), result AS (
    SELECT conv_id, turn, text, 'reply-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), record AS (
    SELECT c.conv_id, c.turn, 0 AS place, 'call' AS kind, c.call_id, r.conv_id IS NOT NULL AS linked,
           CASE WHEN c.text IS NULL THEN 'type of prompt' ELSE '' END AS errors,
           CAST(json_object(
               'call', json_object('arguments', json_object('prompt', c.text, 'turn', c.turn),
                                   'id', c.call_id, 'name', 'reply'),
               'result', CASE WHEN r.conv_id IS NOT NULL THEN json_object('content', r.text, 'turn', r.turn) END,
               'turn', c.turn) AS VARCHAR) AS record
    FROM call c LEFT JOIN result r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
    UNION ALL
    SELECT conv_id, turn, 0, 'orphan', call_id, false, 'no call',
           CAST(json_object('call', NULL, 'result', json_object('content', text, 'turn', turn), 'turn', turn) AS VARCHAR)
    FROM result r
    WHERE NOT EXISTS (SELECT 1 FROM call c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
    UNION ALL
    SELECT conv_id, turn, -1, 'message', NULL, false, '',
           CAST(json_object('content', text, 'role', role, 'turn', turn) AS VARCHAR)
    FROM conversations WHERE role NOT IN ('user', 'assistant')
)
SELECT conv_id, turn,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn, place, kind, record) - 1 AS seq,
       kind, call_id, linked, errors, record
FROM record
"""
