"""Classifying raw frames with JVM expressions only: no user function ever sees a row.

A frame is *usable*, *skipped* (a kind that is deliberately not modelled) or *undeliverable* with
the first fault found, tested in this order: JSON, object, kind, time_us, did, commit, collection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settle.schema import COMMIT_KIND, IGNORED_KINDS

USABLE, SKIPPED, UNDELIVERABLE = "usable", "skipped", "undeliverable"


def text_of(value: Column) -> Column:
    """The frame as text, NULL if its bytes are not UTF-8."""
    text = value.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def _fits_array(text: Column) -> Column:
    """Whether the text reads as one array element, or closes the array itself."""
    length = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce(length == 2, F.lit(False))


def body_of(text: Column) -> Column:
    """A variant holding the parsed frame as its one member ``frame``; NULL if it is not JSON.

    The parser would ignore text after the frame. Read as a member of an object, such text has to
    close the object or bring a further member; read as an element of an array, close the array or
    bring a further element. Nothing is both, so a text that passes both is exactly one value.
    """
    wrapped = F.concat(F.lit('{"frame":'), text, F.lit("}"))
    return F.when(_fits_array(text), F.try_parse_json(wrapped))


def is_json(text: Column) -> Column:
    """Exactly one JSON value and nothing after it."""
    return body_of(text).isNotNull()


def _member(body: Column, path: str) -> Column:
    return F.try_variant_get(body, f"$.frame{path}", "variant")


def _type(value: Column) -> Column:
    # The declared type, not a cast: a cast would take true for 1 and "5" for 5.
    return F.coalesce(F.schema_of_variant(value), F.lit(""))


def _typed(body: Column, path: str, variant_type: str, spark_type: str) -> Column:
    typed = F.try_variant_get(body, f"$.frame{path}", spark_type)
    return F.when(_type(_member(body, path)) == variant_type, typed)


def envelope_of(body: Column) -> Column:
    """What routing needs of a frame, each NULL unless present with the right JSON type.

    ``kind`` is compared as text only, and no value but the string itself reads as its text.
    """
    return F.struct(
        F.try_variant_get(body, "$.frame.kind", "string").alias("kind"),
        _typed(body, ".time_us", "BIGINT", "bigint").alias("time_us"),
        _typed(body, ".did", "STRING", "string").alias("did"),
        (_type(_member(body, ".commit.collection")) == "STRING").alias("has_collection"),
    )


def status_of(envelope: Column) -> Column:
    usable = (
        (envelope["kind"] == COMMIT_KIND)
        & (envelope["time_us"] > 0)
        & (envelope["did"] != "")
        & envelope["has_collection"]
    )
    return (
        F.when(usable, USABLE)
        .when(envelope["kind"].isin(*IGNORED_KINDS), SKIPPED)
        .otherwise(UNDELIVERABLE)
    )


def _shown(body: Column, name: str) -> Column:
    value = F.coalesce(F.to_json(_member(body, f".{name}")), F.lit("missing"))
    return F.concat(F.lit(f"{name} is "), value)


def fault_of(envelope: Column, body: Column) -> Column:
    """The first fault of an undeliverable frame."""

    def unless(good: Column) -> Column:
        return ~F.coalesce(good, F.lit(False))

    return (
        F.when(body.isNull(), "not JSON")
        .when(~_type(_member(body, "")).startswith("OBJECT"), "envelope is not an object")
        .when(unless(envelope["kind"] == COMMIT_KIND), _shown(body, "kind"))
        .when(unless(envelope["time_us"] > 0), _shown(body, "time_us"))
        .when(unless(envelope["did"] != ""), _shown(body, "did"))
        .when(
            ~_type(_member(body, ".commit")).startswith("OBJECT"),
            "commit is missing or not an object",
        )
        .otherwise("commit.collection is missing or not a string")
    )
