"""The work queue: plain operations on frames, and a queue of one driver that is kept in a file.

Claims are serialised by a lock of the driver; workers of other drivers must
not share a queue file.
"""

from __future__ import annotations

import json
import logging
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["hypertable", "chunk_id"]
log = logging.getLogger("tidemill")


def enqueue(planned: DataFrame, tasks: DataFrame) -> DataFrame:
    """Planned chunks that the queue lacks; those it has keep their old filter."""
    return planned.join(tasks.select(*KEYS), KEYS, "left_anti")


def with_priority(planned: DataFrame) -> DataFrame:
    """Adds priority from 1: newest chunk first, then by table and chunk. The plan is small: one row a chunk."""
    return planned.withColumn("priority", F.row_number().over(Window.orderBy(F.desc("range_start"), "hypertable", "chunk_id")))


def pending(tasks: DataFrame, verify: bool = False) -> DataFrame:
    return tasks.filter("worked is not null and verified is null" if verify else "worked is null")


def next_task(tasks: DataFrame, verify: bool = False) -> DataFrame:
    return pending(tasks, verify).orderBy("priority").limit(1)


class TaskQueue:
    """Tasks as dictionaries, saved after every change; unique by table and chunk."""

    def __init__(self, path: str):
        self.path, self.lock, self.tasks = Path(path), threading.Lock(), []
        if self.path.exists():
            self.tasks = json.loads(self.path.read_text())
        self._claimed: set[int] = set()

    def _save(self) -> None:
        new = self.path.with_suffix(".new")
        new.write_text(json.dumps(self.tasks))
        new.replace(self.path)

    def enqueue(self, planned: list[dict]) -> tuple[int, int]:
        """(staged, skipped)."""
        with self.lock:
            have = {(t["hypertable"], t["chunk_id"]) for t in self.tasks}
            new = [p for p in planned if (p["hypertable"], p["chunk_id"]) not in have]
            first = max((t["priority"] for t in self.tasks), default=0) + 1
            self.tasks += [p | {"priority": first + k, "worked": None, "verified": None, "message": None} for k, p in enumerate(new)]
            self._save()
            return len(new), len(planned) - len(new)

    def count_pending(self, verify: bool = False) -> int:
        return sum(self._waits(t, verify) for t in self.tasks)

    @staticmethod
    def _waits(task: dict, verify: bool) -> bool:
        return task["worked"] is not None and task["verified"] is None if verify else task["worked"] is None

    def claim(self, verify: bool = False) -> dict | None:
        with self.lock:
            for task in sorted(self.tasks, key=lambda t: t["priority"]):
                if self._waits(task, verify) and task["priority"] not in self._claimed:
                    self._claimed.add(task["priority"])
                    return dict(task)
        return None

    def claim_all(self, verify: bool = False) -> list[dict]:
        """All tasks that wait, in order; an error if there is none."""
        out = []
        while (task := self.claim(verify)) is not None:
            out.append(task)
        if not out:
            raise RuntimeError(self._none(verify))
        return out

    def _none(self, verify: bool) -> str:
        return "no copied chunk waits to be verified: copy first" if verify and self.tasks else "no pending task: stage first"

    def complete(self, task: dict, began: float, message: str, verify: bool = False) -> None:
        with self.lock:
            own = next(t for t in self.tasks if t["priority"] == task["priority"])
            own["verified" if verify else "worked"] = [began, time.time()]
            own["message"] = message
            self._claimed.discard(task["priority"])
            self._save()

    def give_back(self, task: dict) -> None:
        with self.lock:
            self._claimed.discard(task["priority"])

    def drain(self, work: Callable[[dict], str], parallelism: int = 8, verify: bool = False, stop: threading.Event | None = None) -> int:
        """Work off all pending tasks; a task that raises stays pending and ends the run. stop: finish what runs, claim no more."""
        total = self.count_pending(verify)
        if not total:
            raise RuntimeError(self._none(verify))
        stop, failed, done = stop or threading.Event(), [], []

        def worker() -> None:
            while not stop.is_set() and not failed and (task := self.claim(verify)):
                began = time.time()
                try:
                    message = work(task)
                    self.complete(task, began, message, verify)
                    done.append(task)
                    log.warning("[%d/%d] %s: %s", len(done), total, task["chunk_id"], message.splitlines()[0])
                except BaseException as error:
                    self.give_back(task)
                    failed.append(error)

        with ThreadPoolExecutor(parallelism) as pool:
            for _ in range(parallelism):
                pool.submit(worker)
        if failed:
            raise failed[0]
        return len(done)

    def clean(self) -> None:
        self.path.unlink(missing_ok=True)
        self.tasks = []
