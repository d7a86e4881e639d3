"""Tool calls joined with their results, ordered, checked and written as canonical JSON.

Calls and results meet by a join on conversation and call id. A call may need others; its
level is one more than the highest level of those. Where every call stands behind what it
needs, as logs usually have it, the position orders the conversation and no level is
computed. Other conversations are levelled: a call is done once all it needs are. A conversation
of bounded size is one group for that, larger ones are levelled together in rounds. What never
gets done is part of a circle or needs one; it keeps its position behind the rest.
The order is (level, position) and stays in columns, as numbering a conversation would take
all its rows into one task.

Arguments are checked against the schema of their tool: required and unknown fields and
types, as in JSON Schema (an integer is a number, a boolean is not). Canonical JSON has sorted
keys, no blanks and characters as they are.

Defined cases: of calls that repeat an id the first by (position, name, arguments) stays, of
results likewise by (position, content). A result without a call is an orphan, a call without
a result has null there. Needs that no call has are reported as errors and do not block.
Arguments that are no JSON object are reported; null arguments count as {}. Null ids never
join: such calls and results stay alone. An empty table gives an empty one. Rows are built
from the named columns only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written

GROUP = 100_000
TYPES = {"string": str, "number": (int, float), "integer": int, "boolean": bool, "array": list, "object": dict}
LINKED = "conv_id long, kind string, level long, position long, call_id string, valid boolean, errors array<string>, json string"


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def problems(arguments, schema: dict | None) -> list[str]:
    """What the arguments of a call break; schema has properties (name: type) and required."""
    if schema is None:
        return ["unknown tool"]
    if not isinstance(arguments, dict):
        return ["arguments are no object"]
    found = [f"missing {name}" for name in sorted(schema.get("required", ())) if name not in arguments]
    for name in sorted(arguments):
        kind = schema["properties"].get(name)
        if kind is None:
            found.append(f"unknown {name}")
        elif not isinstance(arguments[name], TYPES[kind]) or (isinstance(arguments[name], bool) and kind != "boolean"):
            found.append(f"{name} is no {kind}")
    return found


def _serialised(schemas: dict[str, dict]):
    def line(row: dict) -> tuple[bool, list[str], str]:
        if row["kind"] == "orphan":
            return False, ["result without call"], canonical({"id": row["call_id"], "result": row["content"]})
        try:
            arguments = json.loads(row["arguments"]) if row["arguments"] is not None else {}
            errors = problems(arguments, schemas.get(row["name"]))
            body = {"arguments": arguments, "id": row["call_id"], "name": row["name"], "result": row["content"]}
            text = canonical(body)
        except ValueError:
            errors = ["arguments are no JSON"]
            text = canonical({"arguments": row["arguments"], "id": row["call_id"], "name": row["name"], "result": row["content"]})
        errors += [f"needs {x}" for x in sorted(row["absent"] or ())]
        if row["level"] is None:
            errors.append("circular")
        return not errors, errors, text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, errors, texts = zip(*map(line, batch.to_pylist()), strict=True) if len(batch) else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "kind", "level", "position", "call_id")),
                    pa.array(valid, pa.bool_()),
                    pa.array(errors, pa.list_(pa.string())),
                    pa.array(texts, pa.string()),
                ],
                names=[part.split(" ")[0] for part in LINKED.split(", ")],
            )

    return run


def _group_levels(group: pa.Table) -> pa.Table:
    """The levels of the calls of one conversation; calls of a circle, or that need one, get none."""
    calls = dict(zip(group["call_id"].to_pylist(), group["needs"].to_pylist(), strict=True))
    waits = {call: len(needs) for call, needs in calls.items()}
    wanted: dict[str, list[str]] = {}
    for call, needs in calls.items():
        for need in needs:
            wanted.setdefault(need, []).append(call)
    levels, ready, level = {}, [call for call, n in waits.items() if not n], 0
    while ready:
        levels |= dict.fromkeys(ready, level)
        after = []
        for call in ready:
            for other in wanted.get(call, ()):
                waits[other] -= 1
                if not waits[other]:
                    after.append(other)
        ready, level = after, level + 1
    conv = pa.array([group["conv_id"][0].as_py()] * len(levels), pa.int64())
    return pa.table([conv, pa.array(levels.keys(), pa.string()), pa.array(levels.values(), pa.int64())], names=["conv_id", "call_id", "level"])


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id and level of the calls of conversations that stand out of order.

    A conversation of up to `GROUP` calls and needs is levelled in one go. One with more is
    levelled together with its like, in a round for each level.
    """
    key = ["conv_id", "call_id"]
    late = needs.where("need_position >= position").select("conv_id").distinct()
    open_calls = calls.join(late, "conv_id", "left_semi").select(*key)
    edges = needs.join(late, "conv_id", "left_semi").select(*key, "need")
    listed = open_calls.unionByName(edges.select(*key)).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    large = written(listed.where(F.col("n") > GROUP).select("conv_id"), "large-conversations")
    small = open_calls.select(*key, F.lit(None).cast("string").alias("need")).unionByName(edges).join(large, "conv_id", "left_anti")
    small = small.groupBy(*key).agg(F.collect_set("need").alias("needs"))
    done = small.groupBy("conv_id").applyInArrow(_group_levels, "conv_id long, call_id string, level long")
    if large.isEmpty():
        return done
    open_calls = written(open_calls.join(large, "conv_id", "left_semi"), "open-calls")
    edges = written(edges.join(large, "conv_id", "left_semi"), "open-needs")
    level = 0
    while True:
        ready = written(open_calls.join(edges, key, "left_anti").withColumn("level", F.lit(level).cast("long")), "ready-calls")
        if ready.isEmpty():
            return done
        done = done.unionByName(ready)
        open_calls = written(open_calls.join(ready, key, "left_anti"), "open-calls")
        met = ready.select("conv_id", F.col("call_id").alias("need"))
        edges = written(edges.join(met, ["conv_id", "need"], "left_anti"), "open-needs")
        level += 1


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row for each call, and for each result without one, with its order and canonical JSON.

    calls: conv_id, position, call_id, name, arguments (JSON), needs (ids). results: conv_id,
    position, call_id, content.
    """
    key = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    fields = ("position", "name", "arguments", "needs")
    own = calls.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", *fields)
    first = own.where(named).groupBy(*key).agg(F.min(F.struct(*fields)).alias("x")).select(*key, *(f"x.{c}" for c in fields))
    answers = results.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("position").alias("answered"), "content")
    answer = answers.where(named).groupBy(*key).agg(F.min(F.struct("answered", "content")).alias("x")).select(*key, "x.answered", "x.content")

    wanted = first.select(*key, "position", F.explode(F.array_distinct("needs")).alias("need"))
    places = first.select("conv_id", F.col("call_id").alias("need"), F.col("position").alias("need_position"))
    met = wanted.join(places, ["conv_id", "need"], "left")
    absent = met.where("need_position is null").groupBy(*key).agg(F.collect_set("need").alias("absent"))
    present = met.where("need_position is not null")
    levels = _levels(first, present)
    out_of_order = present.where("need_position >= position").select("conv_id").distinct().withColumn("late", F.lit(True))

    both = first.join(answer, key, "full")
    both = both.join(absent, key, "left").join(levels, key, "left").join(out_of_order, "conv_id", "left")
    is_call = F.col("position").isNotNull() | F.col("name").isNotNull() | F.col("arguments").isNotNull() | F.col("needs").isNotNull()
    alone = own.where(~named).select("conv_id", "call_id", *fields, F.lit(None).cast("long").alias("answered"), F.lit(None).cast("string").alias("content"), F.lit(True).alias("is_call")).unionByName(
        answers.where(~named).select("conv_id", "call_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("array<string>").alias("needs"), "answered", "content", F.lit(False).alias("is_call"))
    )
    rows = both.withColumn("is_call", is_call).unionByName(
        alone.withColumns({"absent": F.lit(None).cast("array<string>"), "level": F.lit(0).cast("long"), "late": F.lit(None).cast("boolean")})
    )
    return rows.select(
        "conv_id",
        F.when(F.col("is_call"), "call").otherwise("orphan").alias("kind"),
        F.when(F.col("is_call") & F.coalesce("late", F.lit(False)), F.col("level")).otherwise(F.lit(0)).cast("long").alias("level"),
        F.coalesce("position", "answered").cast("long").alias("position"),
        "call_id",
        "name",
        "arguments",
        "content",
        "absent",
    ).mapInArrow(_serialised(schemas), LINKED)


#: The tools of a dialogue.
DIALOGUE = {
    "ask": {"properties": {"question": "string", "turn": "integer"}, "required": ["question", "turn"]},
    "instruct": {"properties": {"instruction": "string"}, "required": ["instruction"]},
}


def from_dialogues(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dialogues as tool use: a turn of the user asks, the assistant's next turn answers it.

    A turn of the system instructs, and of any other role calls a tool of the role's name, which
    no schema knows. What a question needs follows from its whole text, so that dialogues have
    all kinds of orders: by its checksum the question before, two turns earlier, or the one after
    it, or the dialogue's first turn besides, or nothing. So does how it is put: by the number of
    its characters some give their turn as text, and some a field too many.
    """
    role, turn = F.col("role"), F.col("turn")
    named = lambda number: F.concat(F.lit("turn-"), number.cast("string"))
    text = F.coalesce("text", F.lit(""))
    kind, size = F.crc32(text) % 4, F.char_length(text) % 7
    before = F.when(turn >= 2, named(turn - 2))
    needs = F.when(kind == 0, F.array(before)).when(kind == 1, F.array(named(turn + 2))).when(kind == 2, F.array(before, F.when(turn > 0, named(F.lit(0)))))
    needs = F.when((role == "user") & (kind < 3), F.array_compact(needs)).otherwise(F.array().cast("array<string>"))
    question = F.to_json(
        F.struct(
            F.col("text").alias("question"),
            F.when(size > 0, turn).alias("turn"),
            F.when(size == 1, F.lit("more")).alias("note"),
        )
    )
    wrong = F.to_json(F.struct(F.col("text").alias("question"), turn.cast("string").alias("turn")))
    instruction = F.to_json(F.struct(F.col("text").alias("instruction")))
    calls = turns.where(~role.eqNullSafe("assistant")).select(
        "conv_id",
        turn.alias("position"),
        named(turn).alias("call_id"),
        F.when(role == "user", "ask").when(role == "system", "instruct").otherwise(role).alias("name"),
        F.when((role == "user") & (size == 0), wrong).when(role == "user", question).otherwise(instruction).alias("arguments"),
        needs.alias("needs"),
    )
    results = turns.where(role == "assistant").select(
        "conv_id", turn.alias("position"), named(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
