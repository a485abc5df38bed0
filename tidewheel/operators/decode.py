"""Decoding: flat string maps from the wire to event rows with a fixed envelope and a dynamic payload. One projection, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.payload import as_object, is_json, json_value, member, non_empty, text_of

#: Keys of a payload that may stand at the top level (fixed values); those that may hold JSON.
PAYLOAD_KEYS = ("session_id", "snippet", "summary", "task_ref", "handoff")
JSON_KEYS = ("task_ref", "handoff")
#: Columns of the envelope and their keys on the wire (fixed values).
ENVELOPE = {"envelope_id": "id", "ts": "timestamp", "actor": "actor", "action": "action", "target": "target", "team": "team", "project": "project"}
RAW_COLUMNS = ["stream_id", *ENVELOPE, "payload", "fields", "decode_ok"]


def quoted(text: Column) -> Column:
    """A string as a JSON literal."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _known_payload(fields: Column) -> Column:
    """JSON object of the payload keys that stand in the flat map."""
    parts = []
    for key in sorted(PAYLOAD_KEYS):
        value = non_empty(fields[key])
        literal = F.when(is_json(value), value).otherwise(quoted(value)) if key in JSON_KEYS else quoted(value)
        parts.append(F.when(value.isNotNull(), F.concat(F.lit(f'"{key}":'), literal)))
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))


def decode(wire: DataFrame) -> DataFrame:
    """(stream_id, fields map<string,string>, ...) to event rows: RAW_COLUMNS and decode_error; other columns pass through.

    The envelope is the JSON object under `json`, or under `envelope` if `json` is absent; an invalid one marks the row and
    the flat keys stand in. Empty strings count as missing. Envelope strings win over flat keys.
    """
    keep = [c for c in wire.columns if c not in ("fields", *RAW_COLUMNS)]
    fields = F.coalesce(F.col("fields"), F.create_map().cast("map<string,string>"))
    rows = wire.withColumn("fields", fields).withColumn("__candidate", F.coalesce(F.col("fields")["json"], F.col("fields")["envelope"]))
    rows = rows.withColumn("__value", json_value(F.col("__candidate"))).withColumn("__flat", json_value(F.col("fields")["payload"]))
    rows = rows.withColumn("__env", as_object(F.col("__value")))
    columns = {name: F.coalesce(non_empty(text_of(member(F.col("__env"), key))), non_empty(F.col("fields")[key])) for name, key in ENVELOPE.items()}
    own = F.coalesce(as_object(F.col("__flat")), F.try_parse_json(_known_payload(F.col("fields"))))
    valid = F.col("__env").isNotNull()
    payload = F.when(valid, F.coalesce(member(F.col("__env"), "payload"), F.parse_json(F.lit("{}")))).otherwise(own)
    bad = F.col("__candidate").isNotNull() & ~valid
    error = F.when(bad & F.col("__value").isNotNull(), "json/envelope is not a JSON object").when(bad, "json/envelope is invalid JSON")
    ordered = F.map_from_entries(F.array_sort(F.map_entries("fields")))
    return rows.select(*keep, "stream_id", *(c.alias(n) for n, c in columns.items()), payload.alias("payload"), ordered.alias("fields"), (~bad).alias("decode_ok"), error.alias("decode_error"))


def raw_line(prefix: str = "") -> Column:
    """An event row as its JSON line: keys in the order of the columns, nulls written."""
    c = lambda n: F.col(f"{prefix}{n}")
    return F.to_json(F.struct(*(c(n).alias(n) for n in RAW_COLUMNS)), {"ignoreNullFields": "false"})
