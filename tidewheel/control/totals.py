"""What a dataset holds as a few sums, kept beside the checkpoint, so that a batch costs what it brings and not what is stored.

The sums are additive: a batch adds its events and the change of the partitions that its sessions touch. They name the
checkpoint that they belong to; where that isn't the stored one, they are made anew by a scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from tidewheel.control.checkpoint import replace_file

NAME = "TOTALS.json"
WAITING = ("open", "interrupted")


@dataclass
class Totals:
    """checkpoint: that of the sums; last: the largest stored id; bytes by date; open: partitions (team_safe, dt) with sessions that a finish may still meet."""

    checkpoint: str = "0"
    last: str = "0"
    events: int = 0
    office: dict[str, int] = field(default_factory=dict)
    teams_bytes: dict[str, int] = field(default_factory=dict)
    sessions: dict[str, int] = field(default_factory=dict)
    states: dict[str, int] = field(default_factory=dict)
    teams: list[str] = field(default_factory=list)
    open: list[list[str]] = field(default_factory=list)

    def per_date(self) -> dict[str, int]:
        """Bytes of each date in all views."""
        return {dt: self.office.get(dt, 0) + self.teams_bytes.get(dt, 0) + self.sessions.get(dt, 0) for dt in {*self.office, *self.teams_bytes, *self.sessions}}

    def add_events(self, dates: Iterable, teams: Iterable[str]) -> None:
        """Rows (dt, n, bytes) of new events, which both views get."""
        for r in dates:
            self.events += r.n
            for side in (self.office, self.teams_bytes):
                side[r.dt] = side.get(r.dt, 0) + r.bytes
        self.teams = sorted({*self.teams, *teams})

    def add_sessions(self, changes: Iterable) -> None:
        """Rows of Store.upsert."""
        waiting = {tuple(p) for p in self.open}
        changes = list(changes)
        waiting -= {(r.team_safe, r.dt) for r in changes}
        for r in changes:
            self.states[r.state] = self.states.get(r.state, 0) + r.n - r.n_before
            self.sessions[r.dt] = self.sessions.get(r.dt, 0) + r.bytes - r.bytes_before
            if r.n and r.state in WAITING:
                waiting.add((r.team_safe, r.dt))
        self.open = sorted(map(list, waiting))


def read(folder: Path) -> Totals | None:
    """None if there are none or they can't be read."""
    try:
        return Totals(**json.loads((Path(folder) / NAME).read_text()))
    except (OSError, ValueError, TypeError):
        return None


def write(folder: Path, totals: Totals) -> None:
    replace_file(Path(folder) / NAME, json.dumps(asdict(totals)))


def forget(folder: Path) -> None:
    (Path(folder) / NAME).unlink(missing_ok=True)
