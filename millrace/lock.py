"""One run at a time: a lock file with the owner's process id. A dead owner's lock is taken over."""

from __future__ import annotations

import contextlib
import json
import os
from collections.abc import Iterator
from datetime import datetime
from pathlib import Path


class Busy(SystemExit):
    pass


def _alive(pid: object) -> bool:
    try:
        os.kill(int(pid), 0)  # type: ignore[arg-type]
    except (OSError, TypeError, ValueError):
        return False
    return True


def owner(path: Path) -> dict | None:
    try:
        return json.loads(path.read_text(encoding="utf-8"))
    except FileNotFoundError:
        return None
    except ValueError:
        return {}


@contextlib.contextmanager
def run_lock(path: str | Path) -> Iterator[None]:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    while True:
        try:
            handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            break
        except FileExistsError:
            held = owner(path)
            if held and _alive(held.get("pid")):
                raise Busy(f"process {held['pid']} has been running since {held.get('started')}; delete {path} if it is gone") from None
            path.unlink(missing_ok=True)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump({"pid": os.getpid(), "started": datetime.now().isoformat(timespec="seconds")}, f)
    try:
        yield
    finally:
        path.unlink(missing_ok=True)
