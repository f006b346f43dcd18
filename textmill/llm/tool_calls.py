"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Messages are plain, calls or results. Calls and results meet in a hash join on conversation and call id, each side
reduced to its first message per id before, so a repeated id can't multiply rows. A string argument ``"$id"`` uses the
result of that call. Messages keep their turns unless one stands before what it needs; such a message, and what needs
it, moves to a later wave until every message follows what it needs. Waves are found by repeated joins over the
conversations with such a message only, mostly none. Arguments are checked against a schema per tool in column
expressions and written with sorted keys and no blanks.

One row per message, never a row per conversation, so a conversation may hold any share of all messages. Column
functions only.

Edge cases: a null conversation is a conversation; a call or result without id is ``unidentified``; of messages with the
same kind and id the earliest turn counts and later ones are ``repeated``; an unknown tool, broken JSON or a reference
to no call is an error of the call; messages in or behind a circle of references get the error ``circular`` and come last;
repeated rows stay; null texts are left out of the JSON; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import places, salted
from textmill.storage import stage_table

PLAIN, CALL, RESULT = "message", "call", "result"
Schema = dict[str, dict[str, tuple[str, bool]]]
# The tools of the registered query; property: (type, required).
TOOLS: Schema = {
    "compute": {"limit": ("integer", True), "query": ("string", True)},
    "lookup": {"after": ("string", False), "limit": ("integer", False), "query": ("string", True)},
    "search": {"after": ("string", True), "limit": ("integer", True), "query": ("string", True)},
}
_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "object": "OBJECT.*",
    "array": "ARRAY.*",
}
COLUMNS = ("conv_id", "turn", "kind", "role", "text", "call_id", "name", "arguments")
_SALTS = 16


def argument_errors(name: Column, arguments: Column, tools: Schema) -> Column:
    """Array of what is wrong with the arguments of a call, in a fixed order; ``tools`` is a part of the program."""
    parsed = F.try_parse_json(arguments)
    kind = F.schema_of_variant(parsed)
    checks = F.array(F.lit("unknown tool"))
    for tool, properties in tools.items():
        found = []
        for prop, (type_name, required) in sorted(properties.items()):
            value = F.try_variant_get(parsed, f"$.{prop}", "variant")
            wrong = ~F.schema_of_variant(value).rlike(f"^({_TYPES[type_name]})$")
            missing = F.lit(f"{prop}: missing") if required else F.lit(None).cast("string")
            found.append(F.when(value.isNull(), missing).when(wrong, F.lit(f"{prop}: not {type_name}")))
        known = F.array(*(F.lit(p) for p in sorted(properties)))
        others = F.array_sort(F.array_except(F.json_object_keys(arguments), known))
        found_all = F.concat(
            F.array_compact(F.array(*found)), F.transform(others, lambda p: F.concat(p, F.lit(": unknown")))
        )
        checks = F.when(name == tool, found_all).otherwise(checks)
    broken = F.when(parsed.isNull(), F.array(F.lit("no JSON"))).when(
        ~kind.startswith("OBJECT"), F.array(F.lit("no object"))
    )
    return F.coalesce(broken, checks)


def canonical(role: Column, text: Column, kind: Column, call_id: Column, name: Column, arguments: Column) -> Column:
    """One message as JSON with sorted keys; what is null is left out."""
    fields = (
        ("arguments", F.to_json(F.try_parse_json(arguments))),
        ("call_id", _quoted(call_id)),
        ("content", _quoted(text)),
        ("kind", _quoted(kind)),
        ("name", _quoted(name)),
        ("role", _quoted(role)),
    )
    written = F.array_compact(F.array(*(F.concat(F.lit(f'"{key}":'), value) for key, value in fields)))
    return F.concat(F.lit("{"), F.array_join(written, ","), F.lit("}"))


def _quoted(text: Column) -> Column:
    one = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(one, F.lit(2), F.length(one) - 2))


def _references(arguments: Column) -> Column:
    """Distinct ids in strings ``"$id"``. Every string is read to its end, so a quoted "$id" inside one is none."""
    strings = F.regexp_extract_all(arguments, F.lit(r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'), F.lit(1))
    named = F.filter(strings, lambda x: x.startswith("$") & (F.length(x) > 1))
    return F.array_distinct(F.transform(named, lambda x: F.substr(x, F.lit(2))))


def _waves(needs: DataFrame) -> DataFrame | None:
    """(conv_id, kind, call_id, wave, circular) of messages that can't keep their turn, None if all can.

    ``needs`` has a row per message and needed message: conv_id, kind, call_id, turn and the same with ``n_``.
    """
    late = F.col("n_turn") >= F.col("turn")
    moved = needs.filter(late).groupBy(F.col("conv_id").alias("_conv")).agg(F.count(F.lit(1)).alias("limit"))
    moved = stage_table(moved, "moved")
    if moved.isEmpty():
        return None
    some = needs.join(moved, F.col("conv_id").eqNullSafe(F.col("_conv"))).withColumn("late", late.cast("long"))
    some = stage_table(some.drop("_conv"), "needs")
    key = ["conv_id", "kind", "call_id"]
    waves = some.groupBy(*key).agg(F.lit(0).cast("long").alias("wave"), F.max("limit").alias("limit"))
    while True:
        waves = stage_table(waves, "waves")
        needed = waves.select(*(F.col(k).alias(f"w_{k}") for k in key), F.col("wave").alias("n_wave"))
        same = F.col("conv_id").eqNullSafe(F.col("w_conv_id")) & (F.col("n_kind") == F.col("w_kind"))
        same &= F.col("n_call_id") == F.col("w_call_id")
        after = some.join(needed, same, "left").groupBy(*key).agg(
            # A wave beyond the number of late messages can only come from a circle.
            F.least(F.max(F.coalesce("n_wave", F.lit(0)) + F.col("late")), F.max("limit") + 1).alias("wave"),
            F.max("limit").alias("limit"),
        )
        state = lambda df: df.agg(F.sum("wave"), F.count(F.lit(1))).first()
        after = stage_table(after, "waves")
        if state(after) == state(waves):
            return after.select(*key, "wave", (F.col("wave") > F.col("limit")).alias("circular"))
        waves = after


def format_chat(messages: DataFrame, tools: Schema = TOOLS) -> DataFrame:
    """One row per row of ``messages`` (which has :data:`COLUMNS`): conv_id, turn, position, kind, call_id, status,
    errors, json."""
    rows = messages.select(*COLUMNS)
    key = ["conv_id", "kind", "call_id"]
    tagged = rows.filter((F.col("kind") != PLAIN) & F.col("call_id").isNotNull())
    # References are cut out before grouping, so arguments of any length stay where they are.
    used = tagged.select(*key, "turn", _references(F.coalesce("arguments", F.lit(""))).alias("used"))
    first = stage_table(
        used.groupBy(*key).agg(F.min("turn").alias("first_turn"), F.min_by("used", "turn").alias("used")), "first"
    )
    part = lambda kind, prefix: first.filter(F.col("kind") == kind).select(
        F.col("conv_id").alias(f"{prefix}conv"), F.col("call_id").alias(f"{prefix}id"), F.col("first_turn").alias(f"{prefix}turn")
    )
    calls, results = part(CALL, "c_"), part(RESULT, "r_")
    met = F.col("c_conv").eqNullSafe(F.col("r_conv")) & (F.col("c_id") == F.col("r_id"))
    pairs = calls.hint("shuffle_hash").join(results, met, "full")
    links = pairs.select(
        F.coalesce("c_conv", "r_conv").alias("conv_id"), F.coalesce("c_id", "r_id").alias("call_id"), "c_turn", "r_turn"
    )
    links = stage_table(links, "call-links")

    uses = first.filter(F.col("kind") == CALL).select(
        "conv_id", "call_id", F.col("first_turn").alias("turn"), F.explode("used").alias("needed")
    )
    target = links.select(
        F.col("conv_id").alias("t_conv"), F.col("call_id").alias("t_id"), F.col("c_turn").alias("t_call"), F.col("r_turn").alias("t_result")
    )
    found = uses.join(
        target, F.col("conv_id").eqNullSafe(F.col("t_conv")) & (F.col("needed") == F.col("t_id")), "left"
    )
    found = stage_table(found, "references")
    lost = (
        found.filter(F.col("t_call").isNull())
        .groupBy("conv_id", F.lit(CALL).alias("kind"), "call_id")
        .agg(F.array_sort(F.collect_list(F.concat(F.lit("no call "), "needed"))).alias("lost"))
    )
    by_result = links.filter("c_turn is not null and r_turn is not null").select(
        "conv_id",
        F.lit(RESULT).alias("kind"),
        "call_id",
        F.col("r_turn").alias("turn"),
        F.lit(CALL).alias("n_kind"),
        F.col("call_id").alias("n_call_id"),
        F.col("c_turn").alias("n_turn"),
    )
    by_use = found.filter(F.col("t_call").isNotNull()).select(
        "conv_id",
        F.lit(CALL).alias("kind"),
        "call_id",
        "turn",
        F.when(F.col("t_result").isNotNull(), RESULT).otherwise(CALL).alias("n_kind"),
        F.col("needed").alias("n_call_id"),
        F.coalesce("t_result", "t_call").alias("n_turn"),
    )
    waves = _waves(by_result.unionByName(by_use))

    facts = first.select(*key, "first_turn").join(lost.select(*(F.col(k).alias(f"l_{k}") for k in key), "lost"), _same(key, "l_"), "left")
    facts = facts.drop(*(f"l_{k}" for k in key))
    partner = links.select(F.col("conv_id").alias("p_conv"), F.col("call_id").alias("p_id"), "c_turn", "r_turn")
    facts = facts.join(partner, F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("call_id") == F.col("p_id"))).drop("p_conv", "p_id")
    if waves is None:
        facts = facts.withColumn("wave", F.lit(0).cast("long")).withColumn("circular", F.lit(False))
    else:
        renamed = waves.select(*(F.col(k).alias(f"l_{k}") for k in key), "wave", "circular")
        facts = facts.join(renamed, _same(key, "l_"), "left").drop(*(f"l_{k}" for k in key))
    known = salted(tagged, facts, key, _SALTS, F.xxhash64("turn", "text"))
    others = rows.filter((F.col("kind") == PLAIN) | F.col("kind").isNull() | F.col("call_id").isNull())
    both = known.unionByName(others, allowMissingColumns=True)

    is_first = F.col("turn").eqNullSafe(F.col("first_turn"))
    status = (
        F.when(F.coalesce("kind", F.lit(PLAIN)) == PLAIN, "plain")
        .when(F.col("call_id").isNull(), "unidentified")
        .when(~is_first, "repeated")
        .when((F.col("kind") == CALL) & F.col("r_turn").isNotNull(), "answered")
        .when(F.col("kind") == CALL, "unanswered")
        .when(F.col("c_turn").isNotNull(), "linked")
        .otherwise("orphan")
    )
    none = F.array().cast("array<string>")
    errors = F.concat(
        F.when(F.col("kind") == CALL, argument_errors(F.col("name"), F.col("arguments"), tools)).otherwise(none),
        F.when(is_first, F.coalesce("lost", none)).otherwise(none),
        F.when(is_first & F.coalesce("circular", F.lit(False)), F.array(F.lit("circular"))).otherwise(none),
    )
    rank = F.when(F.col("kind") == CALL, 1).when(F.col("kind") == RESULT, 2).otherwise(0)
    out = both.select(
        "conv_id",
        "turn",
        "kind",
        "call_id",
        status.alias("status"),
        errors.alias("errors"),
        canonical(*(F.col(c) for c in ("role", "text", "kind", "call_id", "name", "arguments"))).alias("json"),
        F.when(is_first, F.coalesce("wave", F.lit(0))).otherwise(0).cast("long").alias("_wave"),
        rank.alias("_rank"),
    )
    return places(out, "conv_id", ["_wave", "turn", "_rank", "call_id", "json"]).drop("_wave", "_rank")


def _same(key: list[str], prefix: str) -> Column:
    on = F.lit(True)
    for k in key:
        on &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def from_conversations(conversations: DataFrame) -> DataFrame:
    """Messages with calls, from plain turns: an assistant's turn becomes a call about its whole text, the user's
    turn after it the result. Every fifth limit is written as a string, and a call from turn two on uses the result before."""
    n = F.length("text")
    is_call, is_result = F.col("role") == "assistant", (F.col("role") == "user") & (F.col("turn") > 0)
    call_id = lambda back: F.concat(F.lit("c"), F.col("conv_id"), F.lit("-"), F.col("turn") - back)
    after = F.when(F.col("turn") >= 2, F.concat(F.lit("$"), call_id(2)))
    arguments = F.when(
        n % 5 == 0, F.to_json(F.struct(F.col("text").alias("query"), n.cast("string").alias("limit"), after.alias("after")))
    ).otherwise(F.to_json(F.struct(F.col("text").alias("query"), n.alias("limit"), after.alias("after"))))
    names = F.array(*(F.lit(t) for t in sorted(TOOLS)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(is_call, CALL).when(is_result, RESULT).otherwise(PLAIN).alias("kind"),
        "role",
        F.when(~is_call, F.col("text")).alias("text"),
        F.when(is_call, call_id(0)).when(is_result, call_id(1)).alias("call_id"),
        F.when(is_call, F.get(names, n % 3)).alias("name"),
        F.when(is_call, arguments).alias("arguments"),
    )
