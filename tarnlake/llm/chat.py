"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

The input is a table of messages, one row each: (conv_id, turn, role, text, call_id, tool, arguments, needs).
Rows of role `tool_call` carry a call id, a tool, its arguments as JSON text, and the ids of calls whose results they
use; rows of role `tool_result` carry the id of their call; other roles are plain messages.

Calls and results are joined by (conversation, id). Calls are ordered topologically in rounds: a call is placed once all calls it needs are,
at the latest turn among its own and those of the results it needs. A round goes through the calls of a conversation in the order of
their turns, and back, and places what it can on the way, so needs that follow the turns are met in one round however many a call has and
however long they go on. Conversations of more than `PER_SLICE` calls are cut into slices along the turns, each gone through by itself; between
rounds needs that reach out of a slice are met by a join, and chains of calls with one need each are halved. Calls that are never
placed are on a cycle, or need one. Nothing gathers more than a slice, so a conversation may hold any share of all rows. All of it
is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tarnlake.llm.common import staged, work_path

COLUMNS = ["conv_id", "turn", "role", "text", "call_id", "tool", "arguments", "needs"]
Schema = Mapping[str, tuple[object, bool]]
PER_SLICE = 256
_FAR = 1 << 61      # farther than any chain is long; the sum of two such distances is still a long
_TYPES = {
    "integer": r"(BIGINT|DECIMAL\(\d+,0\))", "number": r"(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "string": "STRING",
    "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*",
}


def _at(path: str, field: str) -> str:
    """Path of a field below another, its name quoted: it may hold dots."""
    quote = '"' if "'" in field else "'"
    return f"{path}[{quote}{field}{quote}]"


def _found(value: Column, text: Column, fields: Schema, path: str = "$", name: str = "") -> list[Column]:
    """What is wrong with an object, one entry per field and null where nothing is, and arrays of unknown fields."""
    faults = []
    for field, (kind, required) in fields.items():
        full, place = f"{name}{field}", _at(path, field)
        part = F.try_variant_get(value, place, "variant")
        seen = F.schema_of_variant(part)
        absent = seen.isNull() | (seen == "VOID")
        fault = F.when(absent, F.lit(f"missing {full}") if required else F.lit(None).cast("string"))
        if isinstance(kind, Mapping):
            held = seen.startswith("OBJECT<")
            fault = fault.when(~held, F.lit(f"type of {full}"))
            inner = [F.when(held, f) for f in _found(value, F.to_json(part), kind, place, f"{full}.")]
        elif isinstance(kind, tuple) and kind[0] == "array":
            fault, inner = fault.when(~seen.rlike(f"^ARRAY<({_TYPES[kind[1]]}|VOID)>$"), F.lit(f"type of {full}")), []
        elif isinstance(kind, (list, tuple)):
            given = F.try_variant_get(value, place, "string")
            fault, inner = fault.when(~seen.rlike("^STRING$"), F.lit(f"type of {full}")).when(~given.isin(*kind), F.lit(f"value of {full}")), []
        else:
            fault, inner = fault.when(~seen.rlike(f"^{_TYPES[kind]}$"), F.lit(f"type of {full}")), []
        faults += [F.array(fault), *inner]
    known = F.array(*(F.lit(f) for f in fields)) if fields else F.array().cast("array<string>")
    return [*faults, F.transform(F.array_except(F.json_object_keys(text), known), lambda key: F.concat(F.lit(f"unknown field {name}"), key))]


def argument_errors(tools: Mapping[str, Schema], tool: Column, arguments: Column) -> Column:
    """Sorted list of what is wrong with a call's arguments; empty where they fit the tool's schema.

    A schema maps fields to (type, required). A type is a name (`integer`, `number`, `string`, `boolean`, `array`, `object`),
    ("array", name of its items' type), a list of the strings allowed, or a schema for an object. Fields a schema does not name are errors, and
    so are arguments that are no JSON object or name a field twice. A null field counts as missing, an empty array fits any type of items. Fields of
    inner objects are called `outer.inner`.
    """
    value = F.try_parse_json(arguments)
    checks = F.array(F.lit("unknown tool"))
    none = F.array().cast("array<string>")
    for name, fields in tools.items():
        parts = [F.coalesce(part.cast("array<string>"), none) for part in _found(value, arguments, fields)]
        checks = F.when(tool == name, F.array_compact(F.concat(*parts))).otherwise(checks)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    return F.array_sort(F.when(tool.isNotNull() & ~tool.isin(*tools), F.array(F.lit("unknown tool"))).when(
        ~is_object, F.array(F.lit("no JSON object"))).otherwise(F.coalesce(checks, F.array(F.lit("unknown tool")))))


def _first_by_id(rows: DataFrame, name: str) -> DataFrame:
    """The earliest row of each (conversation, id), found by a combined minimum; `line` breaks ties between equal turns."""
    return rows.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "line")).alias(name))


def _sliced(calls: DataFrame, per_slice: int) -> DataFrame:
    """Add `slice`: conversations of more than `per_slice` calls are cut by turns, and slices that are still too large by a hash of the id."""
    turn = F.col("turn").cast("double")
    sizes = staged(calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"), F.min(turn).alias("low"), F.max(turn).alias("high")).filter(
        F.col("size") > per_slice), "chat-large")
    if sizes.isEmpty():
        return calls.withColumn("slice", F.lit(0).cast("long"))
    width = F.greatest(F.lit(1.0), F.ceil((F.col("high") - F.col("low") + 1) * per_slice / F.col("size")))
    cut = staged(calls.join(sizes, "conv_id", "left").withColumn(
        "cut", F.coalesce(F.floor((turn - F.col("low")) / width), F.lit(0)).cast("long")).drop("size", "low", "high"), "chat-cut")
    crowds = staged(cut.groupBy("conv_id", "cut").agg(F.ceil(F.count(F.lit(1)) / per_slice).alias("parts")), "chat-crowds")
    part = F.pmod(F.xxhash64("call_id"), F.col("parts"))
    return cut.join(crowds, ["conv_id", "cut"]).withColumn("slice", F.xxhash64("cut", part)).drop("cut", "parts")


def _gone_through(calls: Column) -> Column:
    """Map of the calls of a slice that can be placed, by id: calls are looked at in their order and then back, and one is placed when all it
    still waits for are."""
    def step(done: Column, call: Column) -> Column:
        needs = call["open"]
        ready = F.forall(needs, lambda o: F.map_contains_key(done, o["need"]))
        level = F.greatest(call["level"], F.array_max(F.transform(
            needs, lambda o: F.try_element_at(done, o["need"])["level"] + o["distance"])), F.lit(0).cast("long"))
        before = F.greatest(call["until"], F.array_max(F.transform(
            needs, lambda o: F.greatest(o["latest"], F.try_element_at(done, o["need"])["until"]))))
        entry = F.struct(
            level.alias("level"), F.greatest(call["own"], before).alias("until"), F.greatest(call["turn"], before).alias("slot"))
        return F.when(ready & ~F.map_contains_key(done, call["call_id"]), F.map_concat(done, F.create_map(call["call_id"], entry))).otherwise(done)

    nothing = F.create_map().cast("map<string, struct<level: bigint, until: bigint, slot: bigint>>")
    return F.aggregate(F.concat(calls, F.reverse(calls)), nothing, step)


def place(calls: DataFrame, per_slice: int = PER_SLICE) -> DataFrame:
    """(conv_id, call_id, slot, level) of the calls that can be ordered.

    `calls` is a table of (conv_id, call_id, turn, result_turn, needs) with one row per id. Needs of calls that do not exist
    bind nothing. `level` is the length of the longest chain of needs before a call, `slot` the turn it can stand at.

    Every call points at its needs. A round goes through every slice once; then pointers at placed calls are settled, and a pointer at a call
    with a single need is moved on to what that call points at (its distance and latest turn go along), so chains between slices halve
    with each round. A round places at least one call as long as any can be placed. Pointers on a cycle, or at one, move for as long as rounds go
    on: their distance, which nothing reads, stops growing at `_FAR`. What is placed is one stored table, a folder per round.
    """
    spark, ids = calls.sparkSession, ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("need"))
    wants = calls.select(*ids, F.explode(F.array_distinct("needs")).alias("need")).join(known, ["conv_id", "need"])
    counts = staged(wants.groupBy(*ids).agg(F.count(F.lit(1)).alias("n")), "chat-counts")
    own = F.greatest("turn", "result_turn").alias("own")
    waiting = staged(_sliced(calls.select(*ids, "turn", own), per_slice), "chat-waiting")
    nothing = F.lit(None).cast("long")
    pointers = staged(wants.join(counts, ids).join(waiting.select(*ids, "own"), ids).select(
        *ids, "own", "n", "need", F.lit(1).cast("long").alias("distance"), nothing.alias("latest"),
        nothing.alias("level"), nothing.alias("until")), "chat-pointers")
    folder, done = work_path(spark, "chat-placed"), 0
    kind = waiting.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, call_id string, level long, until long, slot long"
    none = F.array().cast("array<struct<need: string, distance: bigint, latest: bigint>>")
    while True:
        met = pointers.groupBy(*ids).agg(
            F.collect_list(F.when(F.col("need").isNotNull(), F.struct("need", "distance", "latest"))).alias("open"),
            F.max("level").alias("level"), F.max("until").alias("until"))
        entry = F.struct("turn", "call_id", "own", "level", "until", F.coalesce("open", none).alias("open"))
        slices = waiting.join(met, ids, "left").groupBy("conv_id", "slice").agg(F.array_sort(F.collect_list(entry)).alias("calls"))
        placed = slices.select("conv_id", F.explode(_gone_through(F.col("calls"))).alias("call_id", "at"))
        placed.select("conv_id", "call_id", "at.*").write.parquet(f"{folder}/round={done}")
        fresh = spark.read.schema(schema).parquet(f"{folder}/round={done}")
        done += 1
        if fresh.isEmpty():
            break
        waiting = staged(waiting.join(fresh.select(*ids), ids, "left_anti"), "chat-waiting")
        if waiting.isEmpty():
            break
        settled = spark.read.schema(schema).parquet(*(f"{folder}/round={i}" for i in range(done))).select(
            "conv_id", F.col("call_id").alias("need"), F.col("level").alias("level_of"), F.col("until").alias("until_of"))
        left = pointers.join(fresh.select(*ids), ids, "left_anti")
        onward = left.filter("n = 1 AND need IS NOT NULL").select(
            "conv_id", F.col("call_id").alias("need"), F.col("need").alias("next"), F.col("distance").alias("more"),
            F.greatest("own", "latest").alias("later"))
        moved = left.join(settled, ["conv_id", "need"], "left").join(onward, ["conv_id", "need"], "left")
        hit, jumps = F.col("level_of").isNotNull(), F.col("level_of").isNull() & F.col("next").isNotNull()
        pointers = staged(moved.select(
            *ids, "own", "n", F.when(hit, None).when(jumps, F.col("next")).otherwise(F.col("need")).alias("need"),
            F.when(jumps, F.least(F.col("distance") + F.col("more"), F.lit(_FAR))).otherwise(F.col("distance")).alias("distance"),
            F.when(jumps, F.greatest("latest", "later")).otherwise(F.col("latest")).alias("latest"),
            F.when(hit, F.col("level_of") + F.col("distance")).otherwise(F.col("level")).alias("level"),
            F.when(hit, F.greatest("latest", "until_of")).otherwise(F.col("until")).alias("until")), "chat-pointers")
    return spark.read.schema(schema).parquet(*(f"{folder}/round={i}" for i in range(done))).select(*ids, "slot", "level")


def link(messages: DataFrame, tools: Mapping[str, Schema]) -> DataFrame:
    """Every message with its place, status and canonical JSON: (conv_id, slot, level, turn, role, call_id, status, errors, json).

    Sorting a conversation by (slot, level, turn, role, call_id) gives its formatted order; where nothing forces a message later,
    `slot` is its turn. Status of a call: ok, invalid (see `errors`), no result, cycle, duplicate id, no id; of a result: ok, no call,
    duplicate result, no id; of others: ok. Of calls or results that share an id the earliest counts; rows equal in everything are all
    the earliest. Calls and results without an id, or conversations without one, link to nothing. Null texts are left out
    of the JSON. Other columns of the input are not read; an empty table gives no rows.
    """
    line = F.xxhash64("role", "text", "tool", "arguments", F.col("needs").cast("string"))
    rows = staged(messages.select(*(F.col(f"`{c}`") for c in COLUMNS)).withColumn("turn", F.col("turn").cast("long"))
                  .withColumn("line", line), "chat-rows")
    calls, results = rows.filter("role = 'tool_call'"), rows.filter("role = 'tool_result'")
    first_call = _first_by_id(calls, "call")
    first_result = _first_by_id(results, "result")
    linked = staged(first_call.join(first_result, ["conv_id", "call_id"], "full"), "chat-links")
    chosen = linked.filter("call IS NOT NULL")
    needs = calls.select("conv_id", "call_id", "turn", "line", "needs").distinct().join(
        chosen.select("conv_id", "call_id", F.col("call.turn").alias("turn"), F.col("call.line").alias("line"),
                      F.col("result.turn").alias("result_turn")), ["conv_id", "call_id", "turn", "line"])
    placed = place(needs.groupBy("conv_id", "call_id").agg(
        F.min("turn").alias("turn"), F.min("result_turn").alias("result_turn"), F.first("needs").alias("needs")))
    marked = rows.join(linked, ["conv_id", "call_id"], "left").join(placed, ["conv_id", "call_id"], "left")
    own = F.struct("turn", "line")
    is_call, is_result = F.col("role") == "tool_call", F.col("role") == "tool_result"
    marked = marked.withColumn("errors", F.when(is_call, argument_errors(tools, F.col("tool"), F.col("arguments"))))
    status = (
        F.when((is_call | is_result) & (F.col("call_id").isNull() | F.col("conv_id").isNull()), "no id")
        .when(is_call & (F.col("call") != own), "duplicate id")
        .when(is_call & F.col("slot").isNull(), "cycle")
        .when(is_call & (F.size("errors") > 0), "invalid")
        .when(is_call & F.col("result").isNull(), "no result")
        .when(is_result & F.col("call").isNull(), "no call")
        .when(is_result & (F.col("result") != own), "duplicate result")
        .otherwise("ok"))
    tied = (is_call | is_result) & F.col("slot").isNotNull()
    return marked.select(
        "conv_id", F.when(tied, F.greatest("turn", "slot")).otherwise(F.col("turn")).alias("slot"),
        F.when(tied, F.col("level")).otherwise(F.lit(0)).cast("long").alias("level"), "turn", "role", "call_id",
        status.alias("status"), "errors", canonical(is_call).alias("json"))


def canonical(is_call: Column) -> Column:
    """A message as one line of JSON: keys in order, no blanks, arguments in canonical form (as text where they are no JSON)."""
    value = F.try_parse_json(F.col("arguments"))
    parsed = F.to_json(value)
    arguments = F.coalesce(parsed, _quoted(F.col("arguments")))
    parts = F.concat_ws(
        ",",
        F.when(is_call, F.concat(F.lit('"arguments":'), arguments)),
        F.concat(F.lit('"call_id":'), _quoted(F.col("call_id"))),
        F.concat(F.lit('"role":'), _quoted(F.col("role"))),
        F.concat(F.lit('"text":'), _quoted(F.col("text"))),
        F.concat(F.lit('"tool":'), _quoted(F.col("tool"))))
    return F.concat(F.lit("{"), parts, F.lit("}"))


def _quoted(text: Column) -> Column:
    """A JSON string; null stays null."""
    whole = F.to_json(F.struct(text.alias("s")))
    return F.when(text.isNotNull(), whole.substr(F.lit(6), F.char_length(whole) - 6))
