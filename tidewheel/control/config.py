"""Settings: command line over environment over file over default."""

from __future__ import annotations

import os
import stat
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from tidewheel.functions.names import python_max_mb, python_redact_url

#: Names in the file, in the environment, and the defaults (fixed values).
FIELDS = {
    "redis_url": ("TIDEWHEEL_REDIS_URL", "redis://127.0.0.1:6379"),
    "stream": ("TIDEWHEEL_STREAM", "agent-events"),
    "data_dir": ("TIDEWHEEL_DATA_DIR", "data"),
    "max_mb": ("TIDEWHEEL_MAX_MB", None),
    "expire_hours": ("TIDEWHEEL_EXPIRE_HOURS", "6"),
}
FILE_NAME = "tidewheel.toml"
#: Where the program lies: a relative data_dir is meant from here, never from the folder that it was started in.
PROGRAM_DIR = Path(__file__).resolve().parents[2]


class ConfigError(ValueError):
    """A setting that cannot be used; exit code 1."""


@dataclass(frozen=True)
class Config:
    redis_url: str
    stream: str
    data_dir: str
    max_mb: int
    expire_hours: float

    def shown(self) -> dict[str, object]:
        """For logs: without credentials."""
        return {"redis_url": python_redact_url(self.redis_url), "stream": self.stream, "data_dir": self.data_dir, "max_mb": self.max_mb, "expire_hours": self.expire_hours}


def check_private(path: Path) -> None:
    mode = stat.S_IMODE(path.stat().st_mode)
    if mode & 0o077:
        raise ConfigError(f"{path} must be readable by its owner only, not {mode:04o}")


def load(cli: Mapping[str, str | None] | None = None, env: Mapping[str, str] | None = None, cwd: str | Path = ".", program_dir: str | Path | None = None) -> Config:
    """Settings from cli (None: not given), env and a file: cli['config'], TIDEWHEEL_CONFIG, or FILE_NAME beside the program or in cwd.

    An empty string counts as not given. A relative data_dir of the file is relative to the file, any other to the program.
    """
    cli, env = dict(cli or {}), os.environ if env is None else env
    base = Path(program_dir or PROGRAM_DIR)
    named = cli.get("config") or env.get("TIDEWHEEL_CONFIG")
    if named and not Path(named).is_file():
        raise ConfigError(f"there is no file {named}")
    path = Path(named) if named else next((p for p in (base / FILE_NAME, Path(cwd) / FILE_NAME) if p.is_file()), None)
    stored: dict[str, object] = {}
    if path:
        check_private(path)
        try:
            stored = tomllib.loads(path.read_text())
        except tomllib.TOMLDecodeError as error:
            raise ConfigError(f"{path}: {error}") from None
        if unknown := set(stored) - set(FIELDS):
            raise ConfigError(f"{path}: unknown settings {sorted(unknown)}")
    found, where = {}, {}
    for name, (variable, default) in FIELDS.items():
        for source, value in (("cli", cli.get(name)), ("env", env.get(variable)), ("file", stored.get(name)), ("default", default)):
            if value is not None and value != "":
                found[name], where[name] = str(value), source
                break
    try:
        megabytes = python_max_mb(int(found["max_mb"]) if "max_mb" in found else None)
        hours = float(found["expire_hours"])
    except ValueError as error:
        raise ConfigError(str(error)) from None
    if not hours > 0:
        raise ConfigError("expire_hours must be above 0")
    folder = Path(found["data_dir"])
    if not folder.is_absolute():
        folder = (path.parent if where["data_dir"] == "file" and path else base) / folder
    return Config(found["redis_url"], found["stream"], str(folder), megabytes, hours)
