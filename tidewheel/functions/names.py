"""Names: folders of teams, keys of sessions, addresses without credentials."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Actors that belong to no team but the office (fixed values).
OFFICE_ACTORS = ("architect", "staff-engineer", "scrum-master", "super-devops", "lifecycle", "system")
MAX_TEAM = 64


def sanitize(raw: Column) -> Column:
    """Keeps A-Z a-z 0-9 . _ -, a run of anything else becomes one _, leading dots go, 64 characters stay.

    Reading stops at 64 characters before dots go; a _ for a run is read together with the character after it.
    """
    marked = F.regexp_replace(raw, r"[^A-Za-z0-9._\-]+", "\x01")
    read = F.when(F.substring(marked, MAX_TEAM, 1) == "\x01", F.substring(marked, 1, MAX_TEAM + 1)).otherwise(F.substring(marked, 1, MAX_TEAM))
    return F.substring(F.regexp_replace(F.translate(read, "\x01", "_"), r"^[.]+", ""), 1, MAX_TEAM)


def team_safe(team: Column, actor: Column) -> Column:
    """Folder of a team; without a team the office's own actors share one, the others another."""
    office = F.when(F.coalesce(actor, F.lit("")).isin(*OFFICE_ACTORS), "_office").otherwise("_unknown")
    clean = sanitize(team)
    return F.when(F.coalesce(team, F.lit("")) == "", office).when(clean == "", "_unknown").otherwise(clean)


def session_pk(team: Column, actor: Column, stream_id: Column) -> Column:
    """Key of a session: a hash of who and where it begins."""
    empty = F.lit("")
    return F.sha2(F.concat(F.coalesce(team, empty), F.lit("|"), F.coalesce(actor, empty), F.lit("|"), stream_id), 256)


def redact_url(url: Column) -> Column:
    """A URL without what stands before the last @ of its authority."""
    return F.regexp_replace(url, r"^(.*?://)[^/?#]*@", "$1")


def python_redact_url(url: str) -> str:
    head, mark, rest = url.partition("://")
    if not mark:
        return url
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    return head + mark + rest[:end].rpartition("@")[2] + rest[end:]


def max_mb(value: Column) -> Column:
    """Megabytes of the cap: 500 by default and for what is not above 0, at least 16."""
    return F.when(value.isNull() | (value <= 0), 500).otherwise(F.greatest(value, F.lit(16)))


def python_max_mb(value: int | None) -> int:
    return 500 if value is None or value <= 0 else max(16, value)
