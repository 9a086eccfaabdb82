"""One event a command, appended as a JSON line to a local file; nothing is ever sent anywhere."""

from __future__ import annotations

import json
import logging
import platform
import time
import traceback
import uuid
from dataclasses import asdict, dataclass, field
from pathlib import Path


@dataclass
class Event:
    command: str
    session: str = field(default_factory=lambda: uuid.uuid4().hex)
    began: float = field(default_factory=time.time)
    seconds: float = 0.0
    success: bool = True
    error: str | None = None
    causes: list[str] = field(default_factory=list)
    trace: str | None = None
    tasks: int = 0
    tables: int = 0
    rollups: int = 0
    filtered: bool = False
    cascade: list[str] = field(default_factory=list)
    parallelism: int = 0
    spark: str | None = None
    python: str = field(default_factory=platform.python_version)
    system: str = field(default_factory=platform.platform)
    version: int = 2

    def fail(self, error: BaseException) -> None:
        """The error, what it was caused by, and where it was raised."""
        self.success, self.error, self.trace = False, str(error), "".join(traceback.format_tb(error.__traceback__))
        cause = error.__cause__ or error.__context__
        while cause is not None and len(self.causes) < 10:
            self.causes.append(str(cause))
            cause = cause.__cause__ or cause.__context__


def report(event: Event, path: str) -> None:
    """A failure to report never fails the command."""
    try:
        with Path(path).open("a") as out:
            out.write(json.dumps(asdict(event)) + "\n")
    except OSError as error:
        logging.getLogger("tidemill").warning("could not report: %s", error)


def human_bytes(n: float) -> str:
    for unit in ("B", "kB", "MB", "GB", "TB"):
        if n < 1000 or unit == "TB":
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1000
    return ""


def human_seconds(s: float) -> str:
    minutes, seconds = divmod(int(s), 60)
    hours, minutes = divmod(minutes, 60)
    return f"{hours}h{minutes:02}m{seconds:02}s" if hours else f"{minutes}m{seconds:02}s" if minutes else f"{s:.1f}s"


def throughput(n: float, s: float) -> str:
    return f"{human_bytes(n / s)}/s" if s > 0 else "-"
