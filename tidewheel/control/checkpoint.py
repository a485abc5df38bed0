"""How far the stream is stored: one id in a file that is replaced whole."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from tidewheel.functions.ids import python_id

NAME, DROP_LOG, MANIFEST, PENDING = "CHECKPOINT", "DROP_LOG.json", "MANIFEST.json", "PENDING.json"


def replace_file(path: Path, text: str) -> None:
    """Write a private file so that a reader sees the old or the new one."""
    path.parent.mkdir(parents=True, exist_ok=True, mode=0o700)
    fd, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "w") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise
    folder = os.open(path.parent, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


def read(folder: str | Path) -> str:
    """The id; `0` if nothing is stored yet. Anything else than an id is an error, since going on would lose or repeat events."""
    try:
        text = (Path(folder) / NAME).read_text().strip()
    except FileNotFoundError:
        return "0"
    if text and python_id(text) is None:
        raise ValueError(f"the checkpoint holds no stream id: {text!r}")
    return text or "0"


def write(folder: str | Path, stream_id: str) -> None:
    if python_id(stream_id) is None:
        raise ValueError(f"no stream id: {stream_id!r}")
    replace_file(Path(folder) / NAME, stream_id + "\n")


def resume_point(durable: str, written: str | None) -> str:
    """The larger of the checkpoint and the largest id in the dataset, so nothing is stored twice after a crash between both."""
    return max((durable, written or "0"), key=lambda x: python_id(x) or (-1, -1))


def load_drop_log(folder: str | Path) -> list[dict]:
    """Entries of the drop log; none if there is no file or it can't be read."""
    try:
        found = json.loads((Path(folder) / DROP_LOG).read_text())
    except (OSError, ValueError):
        return []
    return found if isinstance(found, list) else []


def append_drop_log(folder: str | Path, entries: list[dict], size: int = 100) -> list[dict]:
    """The last `size` entries after adding some; keys without a value are left out."""
    kept = (load_drop_log(folder) + [{k: v for k, v in e.items() if v is not None} for e in entries])[-size:]
    replace_file(Path(folder) / DROP_LOG, json.dumps(kept, separators=(",", ":")))
    return kept


def bytes_freed(entries: list[dict]) -> int:
    """What the entries of a drop log freed in all."""
    return sum(int(e.get("bytes_freed") or 0) for e in entries)


def read_pending(folder: str | Path) -> dict | None:
    """The batch that was being stored when the writer stopped, if any."""
    try:
        return json.loads((Path(folder) / PENDING).read_text())
    except FileNotFoundError:
        return None
