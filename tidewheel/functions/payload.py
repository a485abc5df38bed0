"""JSON as strict as the wire format asks for, and what is read from a payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_value(text: Column) -> Column:
    """The one JSON value that a text is, null if it is none; JSON's null is a value.

    Spark's parser alone accepts trailing text, so the text is parsed as the only item of an array, and as the only member of
    an object to see that it doesn't end the array itself.
    """
    items = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).cast("array<variant>")
    wrapped = F.try_variant_get(F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))), "$.v", "variant")
    return F.when((F.size(items) == 1) & wrapped.isNotNull(), wrapped)


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing after it."""
    return json_value(text).isNotNull()


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def as_object(value: Column) -> Column:
    """A JSON value if it is an object."""
    return F.when(kind(value).startswith("OBJECT"), value)


def member(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def text_of(value: Column) -> Column:
    """The string that a value is; null for any other type."""
    return F.when(kind(value) == "STRING", value.try_cast("string"))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def payload_session_id(payload: Column) -> Column:
    return non_empty(text_of(member(payload, "session_id")))


def payload_snippet(payload: Column) -> Column:
    return text_of(member(payload, "snippet"))


def payload_refs(payload: Column, name: str) -> Column:
    """The strings of task_ref.<name>; null if there are none."""
    found = F.try_variant_get(payload, f"$.task_ref.{name}", "variant")
    items = F.when(kind(found).startswith("ARRAY"), found.try_cast("array<variant>"))
    strings = F.transform(F.filter(items, lambda x: kind(x) == "STRING"), lambda x: x.try_cast("string"))
    return F.when(F.size(strings) > 0, strings)


def payload_handoff(payload: Column) -> Column:
    """A string as it is, any other value as compact JSON; null only if it is missing."""
    found = member(payload, "handoff")
    return F.when(found.isNotNull(), F.coalesce(text_of(found), F.to_json(found)))


def union_refs(first: Column, second: Column) -> Column:
    """Both lists without repeats, in the order first seen; null if empty."""
    none = F.array().cast("array<string>")
    both = F.array_union(F.coalesce(first, none), F.coalesce(second, none))
    return F.when(F.size(both) > 0, both)
