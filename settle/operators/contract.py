"""Output contracts: same columns, same types, same order, and no NULL where none is allowed.

Rows read from messages also carry the ``message`` and what is wrong with it (``message_error``), so
that a damaged message is rejected with its text and a reason, and never stored as if it had said NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settle.functions.clocks import wire_time
from settle.functions.frames import is_json, text_of
from settle.operators.parse import parse_once
from settle.schema import ROUTES, OutputSpec


#: What rows from messages carry beside the columns of their table.
MESSAGE = ("message", "message_error")


class ContractError(ValueError):
    """The columns offered are not the columns the table has; nothing was written."""


def conform(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Check names, order and types against the stored schema before any write."""
    want = [(f.name, f.dataType) for f in spec.table_schema]
    have = [(f.name, f.dataType) for f in rows.schema if f.name not in MESSAGE]
    if [_loose(t) for t in have] != [_loose(t) for t in want]:
        raise ContractError(
            f"{spec.name}: expected {_shape(want)}, got {_shape(have)}"
        )
    return rows


def _loose(field: tuple[str, T.DataType]) -> tuple[str, str]:
    # simpleString leaves nullability of array elements out
    return field[0], field[1].simpleString()


def _shape(fields: list[tuple[str, T.DataType]]) -> str:
    return ", ".join(f"{name} {kind.simpleString()}" for name, kind in fields)


def violation(rows: DataFrame, spec: OutputSpec) -> Column:
    """What is wrong with the message, or the first required column that is NULL; NULL if nothing."""
    told = [F.col("message_error")] if "message_error" in rows.columns else []
    missing = [F.when(F.col(name).isNull(), F.lit(f"{name} is NULL")) for name in spec.required]
    return F.coalesce(*told, *missing)


def accepted(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    return rows.filter(violation(rows, spec).isNull()).drop(*MESSAGE)


def rejected(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """The rows to quarantine, with the ``reject_reason`` and the message they came in, if any."""
    message = F.col("message") if "message" in rows.columns else F.lit(None).cast("string")
    judged = rows.withColumn("reject_reason", violation(rows, spec)).withColumn("message", message)
    return judged.filter(F.col("reject_reason").isNotNull()).select(
        *spec.table_schema.names, "message", "reject_reason"
    )


def or_fail(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Fail the write on the first bad row. Checked inside the write itself, not in a pass before."""
    first = spec.required[0]
    fault = violation(rows, spec)
    message = F.concat(F.lit(f"{spec.name}: row rejected, "), fault)
    checked = F.when(fault.isNotNull(), F.raise_error(message)).otherwise(F.col(first))
    return rows.withColumn(first, checked).drop(*MESSAGE)


def to_messages(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Rows as ``topic, value``: one JSON object each, timestamps as UTC text, NULLs spelt out."""
    wire = [
        wire_time(F.col(name)).alias(name) if name in spec.times else F.col(name)
        for name in spec.wire_schema.names
    ]
    body = F.to_json(F.struct(*wire), {"ignoreNullFields": "false"})
    return conform(rows, spec).select(
        F.lit(spec.topic).alias("topic"), F.encode(body, "UTF-8").alias("value")
    )


def route(messages: DataFrame, routes: dict[str, OutputSpec] = ROUTES) -> DataFrame:
    """Add ``table_name`` and ``status`` (routed, unrouted, unparseable) to ``topic, value``.

    Skipped messages stay in the result, so that their number is visible.
    """
    table = F.lit(None).cast("string")
    for topic, spec in routes.items():
        table = F.when(F.col("topic") == topic, F.lit(spec.name)).otherwise(table)
    return messages.withColumn("table_name", table).withColumn(
        "status",
        F.when(F.col("table_name").isNull(), "unrouted")
        .when(is_json(text_of(F.col("value"))), "routed")
        .otherwise("unparseable"),
    )


def observed_routing(routed: DataFrame, name: str = "sink") -> DataFrame:
    """Rows written and skipped, as metrics of the query the messages pass through."""
    is_routed = F.col("status") == "routed"
    return routed.observe(
        name,
        F.count_if(is_routed).alias("written"),
        F.count_if(~is_routed).alias("skipped"),
    )


# JSON types a member may have for each type of column, NULL aside.
_JSON_TYPES = {
    "string": ["STRING"],
    "time": ["STRING"],
    "long": ["BIGINT"],
    "int": ["BIGINT"],
    "bool": ["BOOLEAN"],
    "strings": ["ARRAY<STRING>", "ARRAY<VOID>"],
}
_SQL_TYPES = {
    "string": "string",
    "time": "timestamp",
    "long": "bigint",
    "int": "int",
    "bool": "boolean",
    "strings": "array<string>",
}


def rows_for(routed: DataFrame, spec: OutputSpec) -> DataFrame:
    """One table's rows from routed messages, with ``message`` and ``message_error``.

    The message is read as a variant, so every member keeps the type it was sent with. An unknown
    member, a member of another type and a time that is none are errors, told by name. A member that
    is left out, or sent as null, is NULL; whether it may be is for the required columns to say.
    """
    mine = routed.filter((F.col("status") == "routed") & (F.col("table_name") == spec.name))
    text = F.col("value").cast("string")
    parsed = parse_once(mine.withColumn("message", text), F.try_parse_json("message"), "body")
    kind_of = F.schema_of_variant(F.col("body"))
    columns, faults = [], []
    for name, kind in spec.fields:
        member = F.try_variant_get("body", f"$.{name}", "variant")
        typed = F.try_variant_get("body", f"$.{name}", _SQL_TYPES[kind])
        sent = F.coalesce(F.schema_of_variant(member), F.lit("VOID"))
        bad = (sent != "VOID") & (~sent.isin(_JSON_TYPES[kind]) | typed.isNull())
        columns.append(F.when(~bad, typed).alias(name))
        faults.append(F.when(bad, F.lit(f"{name} is not of type {_SQL_TYPES[kind]}")))
    names = F.array(*(F.lit(name) for name in spec.table_schema.names))
    unknown = F.array_except(F.json_object_keys("message"), names)
    first_fault = F.coalesce(
        F.when(~kind_of.startswith("OBJECT"), F.lit("message is not an object")),
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown member "), F.array_min(unknown))),
        *faults,
    )
    return parsed.select(*columns, "message", first_fault.alias("message_error"))
