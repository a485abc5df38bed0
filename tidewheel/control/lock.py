"""One writer for a dataset: a lock file made exclusively, taken over only from a process that is gone."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

NAME, TRIES = ".lock", 10


class Busy(RuntimeError):
    """Another writer holds the dataset; exit code 3."""


def start_time(pid: int) -> str | None:
    """When a process started, to tell it from a later one of the same number."""
    try:
        return Path(f"/proc/{pid}/stat").read_text().rpartition(")")[2].split()[19]
    except (OSError, IndexError):
        return None


def alive(holder: dict) -> bool:
    pid = holder.get("pid")
    return isinstance(pid, int) and start_time(pid) is not None and start_time(pid) == holder.get("start")


class WriterLock:
    def __init__(self, folder: str | Path):
        self.path = Path(folder) / NAME

    def __enter__(self) -> WriterLock:
        self.path.parent.mkdir(parents=True, exist_ok=True, mode=0o700)
        own = {"pid": os.getpid(), "start": start_time(os.getpid())}
        for _ in range(TRIES):
            try:
                fd = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o600)
            except FileExistsError:
                try:
                    holder = json.loads(self.path.read_text())
                except FileNotFoundError:
                    continue
                except ValueError:
                    holder = None  # being written just now, or broken
                if holder is None:
                    time.sleep(0.02)
                    try:
                        holder = json.loads(self.path.read_text())
                    except (OSError, ValueError):
                        holder = {}
                if alive(holder):
                    raise Busy(f"process {holder['pid']} holds {self.path}") from None
                self.path.unlink(missing_ok=True)
                continue
            with os.fdopen(fd, "w") as file:
                json.dump(own, file)
            return self
        raise Busy(f"{self.path} could not be taken")

    def __exit__(self, *_) -> None:
        self.path.unlink(missing_ok=True)
