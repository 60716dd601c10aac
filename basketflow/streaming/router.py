"""Parsing JSON messages and routing them to the raw tables.

Every message is read once into one wide row: its table (``route``), the fields of
that table in their types, NULL elsewhere.  Tables share a column's type wherever they
share its name, so the wide row serves all of them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.functions import try_date, try_id, try_ts

# Message type -> raw table; any other type, none at all and null are events.
ROUTES = {
    "user_profile": "user_profiles", "user_device": "user_devices",
    "user_location": "user_locations", "order": "orders", "order_item": "order_items",
    "campaign_event": "campaign_events", "order_status": "order_status_events",
}
EVENTS = "events"
QUARANTINE = "quarantine"
# Types that are themselves the event type.
LIFECYCLE = ["session_start", "session_end", "signup", "churn"]
SERIAL = {
    "events": "event_id", "user_profiles": "user_profile_id", "user_devices": "user_device_id",
    "user_locations": "user_location_id", "orders": "raw_order_id",
    "order_items": "raw_order_item_id", "campaign_events": "campaign_event_id",
    "order_status_events": "event_id",
}
NUMBERS = {name: i for i, name in enumerate([*schemas.RAW, QUARANTINE])}
# Columns the raw tables do not allow to be missing.
REQUIRED = {"events": ["timestamp"], "order_status_events": ["order_id"]}


def message_fields(table: str) -> list[T.StructField]:
    """The columns of a raw table that come from the message."""
    return [f for f in schemas.RAW[table].fields if f.name not in (SERIAL[table], "received_at")]


def _wide_fields() -> dict[str, tuple[T.DataType, list[str]]]:
    """column -> (type, tables that have it)."""
    wide: dict[str, tuple[T.DataType, list[str]]] = {}
    for table in schemas.RAW:
        for field in message_fields(table):
            kind, tables = wide.setdefault(field.name, (field.dataType, []))
            assert kind == field.dataType, field.name
            tables.append(table)
    return wide


WIDE = _wide_fields()
# JSON has no NaN and no infinities, and the texts that are parsed again may not have them
_JSON = {"allowNonNumericNumbers": "false"}

WIDE_SCHEMA = T.StructType(
    [T.StructField(name, kind) for name, (kind, _) in WIDE.items()]
    + [T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())])


def _typed(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.TimestampNTZType):
        return try_ts(c)
    if isinstance(kind, T.DateType):
        return try_date(c)
    if isinstance(kind, T.IntegralType):
        return try_id(c).try_cast(kind)
    return c.try_cast(kind)


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _one_object(value: Column) -> Column:
    """Whether the text, which ``from_json`` could read, is one JSON object and nothing else but white space.

    ``from_json`` reads the first value only.  In a text whose first closing brace is its end, that
    is the whole text.  Other texts are parsed again: what may follow the value inside an array and
    what may follow it inside an object differ, so with both wrappers nothing can.
    """
    # in bytes: counting the characters of a text costs more than copying it
    ends = F.octet_length(F.substring_index(value, "}", 1)) + 1 == F.octet_length(value)
    flat = value.startswith("{") & ~value.contains("[") & ends
    alone = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    inside = F.size(F.json_object_keys(F.concat(F.lit('{"a":'), value, F.lit("}")))) == 1
    parsed_again = value.rlike(r"^\s*\{") & alone & inside
    return F.coalesce(flat | parsed_again, F.lit(False))


def _complaints(table: str) -> list[Column]:
    """What is wrong with a message of the table, NULL where nothing is; the first counts.

    A column in its type goes by its name behind an underscore.
    """
    found = []
    for name, (kind, tables) in WIDE.items():
        if table in tables and not isinstance(kind, T.StringType):
            found.append(F.when(F.col(name).isNotNull() & F.col(f"_{name}").isNull(),
                                F.lit(f"{name}: not a {kind.simpleString()}")))
    for name in REQUIRED.get(table, []):
        found.append(F.when(F.col(name).isNull(), F.lit(f"{name}: missing")))
    if table == "order_status_events":
        found.append(F.when(~F.col("status").isin(schemas.ORDER_STATUSES), F.lit("status: unknown")))
    return found


def _needed(table: str, only: str | None) -> list[str]:
    """The fields of a table's messages that decide about the rows of the table ``only``, or of all."""
    fields = message_fields(table)
    if only in (None, table):
        return [f.name for f in fields]
    if only != QUARANTINE:
        return []
    checked = {"status", *REQUIRED.get(table, [])}
    return [f.name for f in fields if f.name in checked or not isinstance(f.dataType, T.StringType)]


def _may_be_of(value: Column, table: str) -> Column:
    """False only for texts that cannot be a message of the table.

    Its messages name their type, letter by letter up to the closing quote unless a backslash escapes something.
    """
    named = [value.contains(message_type + quote)
             for message_type, name in ROUTES.items() if name == table for quote in "\"'"]
    return reduce(or_, named, value.contains("\\"))


def _table_of_type(kind: Column) -> Column:
    """The number of the table that messages of a type belong to.

    Tables go by number: a row's table is compared once for each column, and numbers compare faster.
    """
    table = F.lit(NUMBERS[EVENTS])
    for message_type, name in ROUTES.items():
        table = F.when(kind == message_type, F.lit(NUMBERS[name])).otherwise(table)
    return table


def _read_one(messages: DataFrame, table: str) -> tuple[DataFrame, dict[str, Column]]:
    """The fields of one table that has message types of its own, see ``_read``."""
    names = _needed(table, table)
    # inline, here and below, keeps what it makes in one place; what a plain projection makes
    # would be made again in every filter pushed below it.
    messages = messages.select(F.inline(F.array(F.struct("value")))).where(_may_be_of(F.col("value"), table))
    parsed = F.from_json("value", _text_schema(["type", *names]), _JSON)
    # a text that cannot be read has no type and so is not of the table
    read = messages.select("value", parsed.alias("_read"))
    return read.select("*", "_read.type", F.lit(False).alias("_lost")), {name: F.col(f"_read.{name}") for name in names}


def _read(messages: DataFrame, only: str | None) -> tuple[DataFrame, dict[str, Column]]:
    """``value``, ``type``, what was read and ``_lost`` where it cannot be; the text of each needed field.

    Most of the time of ``from_json`` goes with the fields of its schema, so the table is guessed from the text
    and the fields of this table alone are read.  Where the type that was read is not of the table, or
    nothing was read, the text is read again with the fields of all tables.
    """
    value, needed = F.col("value"), {table: _needed(table, only) for table in schemas.RAW}
    names = [name for name in WIDE if any(name in own for own in needed.values())]
    guess = F.lit(NUMBERS[EVENTS])
    for message_type, name in ROUTES.items():
        guess = F.when(value.contains(f'{message_type}"'), F.lit(NUMBERS[name])).otherwise(guess)
    by_guess = [F.when(F.col("_guess") == NUMBERS[table], F.from_json("value", _text_schema(["type", *own]), _JSON))
                .alias(f"_{table}") for table, own in needed.items()]
    # inline keeps what follows above a union of messages, so no wide rows are made for it
    read = messages.select(F.inline(F.array(F.struct("value", guess.alias("_guess")))))
    read = read.select("value", "_guess", *by_guess)
    kind = F.coalesce(*[F.col(f"_{table}.type") for table in needed], F.lit("event"))
    found = F.coalesce(*[F.col(f"_{EVENTS}.{name}") for name in ["type", *needed[EVENTS]]]).isNotNull()
    right = (_table_of_type(kind) == F.col("_guess")) & ((F.col("_guess") != NUMBERS[EVENTS]) | found)
    again = F.from_json("value", _text_schema(["type", *names, "_corrupt"]),
                        {**_JSON, "columnNameOfCorruptRecord": "_corrupt"})
    read = read.select("value", *[f"_{table}" for table in needed], F.when(~right, again).alias("_again"))

    def text(name: str) -> Column:
        """All readings of a field agree."""
        tables = [table for table, own in needed.items() if name in ("type", *own)]
        return F.coalesce(*[F.col(f"_{table}.{name}") for table in [*tables, "again"]])

    nothing = F.coalesce(*[F.col(f"_again.{name}") for name in ["type", *names]]).isNull()
    lost = value.isNull() | (F.col("_again._corrupt").isNotNull() & nothing)
    return read.select("*", text("type").alias("type"), lost.alias("_lost")), {name: text(name) for name in names}


def parse_messages(messages: DataFrame, only: str | None = None) -> DataFrame:
    """``value`` (JSON text) to wide rows with ``route``, ``reason`` and ``value``.

    A message that is no JSON object, has a value its column cannot hold or lacks a
    required one goes to the quarantine, with the reason and its text.

    ``only`` names the one table (or the quarantine) that is wanted: all its rows are there, its columns
    alone are read from the messages, and rows of other tables may be missing.
    """
    value = F.col("value")
    read, texts = _read(messages, only) if only in (None, EVENTS, QUARANTINE) else _read_one(messages, only)
    typed = {name: kind for name, (kind, _) in WIDE.items()
             if name in texts and not isinstance(kind, T.StringType)}
    # in two steps, as the code of a step has to stay small
    read = read.select("*", *[texts[name].alias(name) for name in typed])
    kind_of = F.coalesce("type", F.lit("event"))
    placed = F.when(F.col("_lost") | ~_one_object(value), F.lit(NUMBERS[QUARANTINE])).otherwise(_table_of_type(kind_of))
    read = read.select("*", F.inline(F.array(F.struct(placed.alias("_table")))))
    read = read.select("value", "type", "_table", *typed,
                       *[_typed(F.col(name), kind).alias(f"_{name}") for name, kind in typed.items()],
                       *[text.alias(name) for name, text in texts.items() if name not in typed])

    # A message meets the checks of its own table only.
    complaint = F.lit(None).cast("string")
    for name in schemas.RAW:
        if (only in (None, QUARANTINE, name)) and (here := _complaints(name)):
            complaint = F.when(F.col("_table") == NUMBERS[name], F.coalesce(*here)).otherwise(complaint)
    reason = F.when(F.col("_table") == NUMBERS[QUARANTINE], F.lit("not a JSON object")).otherwise(complaint)
    # Again in one place each: a filter on the route repeats no check, and the code of a row stays in
    # methods that the JVM compiles (beyond 8000 bytes it interprets them).
    marked = read.select("*", F.inline(F.array(F.struct(reason.alias("reason")))))
    target = F.when(F.col("reason").isNull(), F.col("_table")).otherwise(F.lit(NUMBERS[QUARANTINE]))
    title = F.element_at(F.array(*map(F.lit, NUMBERS)), F.col("_route") + 1)
    routed = marked.select("*", F.inline(F.array(F.struct(target.alias("_route")))))

    def column(name: str, kind: T.DataType, tables: list[str]) -> Column:
        if name not in texts:
            return F.lit(None).cast(kind)
        text = F.col(f"_{name}" if name in typed else name)
        if name == "event_type":
            text = F.when(kind_of.isin(LIFECYCLE), kind_of).otherwise(text)
        return F.when(F.col("_route").isin([NUMBERS[t] for t in tables]), text)

    return routed.select(
        title.alias("route"), *[column(name, kind, tables).alias(name) for name, (kind, tables) in WIDE.items()],
        F.when(F.col("reason").isNotNull(), value).alias("value"), "reason")


def fail_on_bad(wide: DataFrame) -> DataFrame:
    """Let the first bad message fail the job."""
    complaint = F.raise_error(F.concat_ws(": ", F.lit("bad message"), "reason", "value"))
    return wide.withColumn("route", F.when(
        F.col("route") == QUARANTINE, complaint.cast("string")).otherwise(F.col("route")))


def table_of(wide: DataFrame, table: str) -> DataFrame:
    """One raw table's rows and message columns."""
    if table == QUARANTINE:
        return wide.where(F.col("route") == QUARANTINE).select("value", "reason")
    return wide.where(F.col("route") == table).select(*[f.name for f in message_fields(table)])


def route(messages: DataFrame, on_bad: str = "quarantine") -> dict[str, DataFrame]:
    """All raw tables and the quarantine, from messages (value)."""
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(on_bad)
    wide = parse_messages(messages)
    if on_bad == "fail":
        wide = fail_on_bad(wide)
    return {table: table_of(wide, table) for table in [*schemas.RAW, QUARANTINE]}


def route_counts(wide: DataFrame) -> DataFrame:
    return wide.groupBy(F.col("route").alias("table_name")).agg(F.count(F.lit(1)).alias("n_rows"))


