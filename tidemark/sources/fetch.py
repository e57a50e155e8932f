"""Files from elsewhere, resumed where a transfer broke off; the transport is a parameter."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path
from typing import Any

#: From headers to (status, chunks of the body).
Transport = Callable[[Mapping[str, str]], tuple[int, Iterable[bytes]]]


def resumed(ask: Transport, path: str | Path) -> str:
    """Fetch a file: ``exists`` if it is there, else ``ok`` once it is whole.

    What has come so far stands in ``PATH.part``; a range is asked for from its
    end on, and an answer that starts anew replaces it.  The name changes only
    when all is there.
    """
    path = Path(path)
    if path.exists():
        return "exists"
    part = path.with_name(path.name + ".part")
    have = part.stat().st_size if part.exists() else 0
    status, body = ask({"Range": f"bytes={have}-"} if have else {})
    if status not in (200, 206):
        raise OSError(f"status {status}")
    path.parent.mkdir(parents=True, exist_ok=True)
    with part.open("ab" if status == 206 and have else "wb") as f:
        for chunk in body:
            f.write(chunk)
    os.replace(part, path)
    return "ok"


def write_atomically(path: str | Path, value: Any) -> None:
    """Write JSON so that readers see the old file or the new one, never a part."""
    path = Path(path)
    part = path.with_name(path.name + ".tmp")
    part.write_text(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True))
    os.replace(part, path)
