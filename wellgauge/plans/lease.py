"""One run at a time.

Two runs over the same tables would use the same checkpoints and write the same hours, so
a run takes a lease on them first. A lease is a file that was created, and not found
there: creating is atomic, so of two runs that try at once one gets it. Leases are
numbered, and the highest counts. It names its owner and the time until which it holds;
the owner renews it while it works, and gives it back at its end. A run that dies leaves
its lease to expire; the next run takes over with the next number, and should the first
be alive after all, it finds that number at its next renewal and ends with an error.

The file system has to offer atomic creation, and clocks have to agree to well within the
time that a lease holds.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import SparkSession

from wellgauge.sinks.folders import create, delete, file_names, read_text


class LeaseHeld(RuntimeError):
    """Another run works on the tables."""


class Lease:
    """``with Lease(spark, folder, seconds):`` around the work. ``check`` raises once
    the lease is lost."""

    def __init__(self, spark: SparkSession, folder: str, seconds: float):
        self._spark, self._folder, self._seconds = spark, folder, seconds
        self._owner = uuid.uuid4().hex
        self._number = -1
        self._lost: Exception | None = None
        self._done = threading.Event()
        self._renewing: threading.Thread | None = None

    def __enter__(self) -> Lease:
        newest = max(self._numbers(), default=-1)
        if newest >= 0:
            held = self._held(newest)
            if held["until"] > time.time():
                raise LeaseHeld(f"a run holds {self._folder} until {time.ctime(held['until'])}")
        self._number = newest + 1
        if not self._write(overwrite=False):
            raise LeaseHeld(f"another run has just taken {self._folder}")
        delete(self._spark, [self._path(n) for n in self._numbers() if n < newest])
        self._renewing = threading.Thread(target=self._renew, daemon=True)
        self._renewing.start()
        return self

    def __exit__(self, *_) -> None:
        self._done.set()
        self._renewing.join()
        if self._lost is None:
            self._write(overwrite=True, seconds=0)

    def check(self) -> None:
        """Raise if another run has taken over, or the lease could not be renewed."""
        if self._lost is not None:
            raise LeaseHeld(f"the lease on {self._folder} is lost") from self._lost

    def _renew(self) -> None:
        while not self._done.wait(self._seconds / 3):
            try:
                if max(self._numbers(), default=self._number) > self._number:
                    raise LeaseHeld("taken over")
                self._write(overwrite=True)
            except Exception as error:  # told by the next check
                self._lost = error
                return

    def _numbers(self) -> list[int]:
        return [int(n) for n in file_names(self._spark, self._folder) if n.isdigit()]

    def _path(self, number: int) -> str:
        return f"{self._folder}/{number}"

    def _held(self, number: int) -> dict:
        """What a lease says. One that is being written holds; it will say so soon."""
        for _ in range(20):
            try:
                return json.loads(read_text(self._spark, self._path(number)))
            except ValueError:
                time.sleep(0.1)
        return {"owner": None, "until": 0}  # its run died in creating it

    def _write(self, overwrite: bool, seconds: float | None = None) -> bool:
        until = time.time() + (self._seconds if seconds is None else seconds)
        text = json.dumps({"owner": self._owner, "until": until})
        return create(self._spark, self._path(self._number), text, overwrite)
