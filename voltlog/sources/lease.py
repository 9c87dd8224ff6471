"""A lease on a warehouse, so that one run at a time changes it.

Leases are numbered files in one folder, and the one with the highest number counts. A new one is made by
exclusive creation of the next number, so of several runs that want it, one gets it; whoever took the number
away from under a slow run is seen by that run when it looks again before its last write. A lease ends when
its owner marks it as given back, or when its time is over; the owner puts that off while it is at work.
"""

from __future__ import annotations

import json
import os
import socket
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from voltlog.sources import hadoop

#: Stores whose creation of a file fails for all but one of several that try.
EXCLUSIVE = ("file", "hdfs", "viewfs", "abfs", "abfss", "wasb", "wasbs")


class LeaseHeld(RuntimeError):
    """Another run has the warehouse."""


class LeaseLost(RuntimeError):
    """The lease ran out during the run and another one has the warehouse now."""


class NoLease(ValueError):
    """The store cannot tell two runs apart that begin at once."""


@dataclass
class Lease:
    spark: SparkSession
    folder: str
    seconds: float = 900.0
    owner: str = field(default_factory=lambda: f"{socket.gethostname()}-{os.getpid()}-{uuid.uuid4().hex}")
    number: int = -1

    def _path(self, number: int, mark: str = "") -> str:
        return f"{self.folder}/{number:012d}{mark}"

    def _highest(self) -> int:
        names = hadoop.names_in(self.spark, self.folder)
        return max((int(n) for n in names if n.isdigit()), default=-1)

    def _held_until(self, number: int) -> tuple[str, float]:
        """Owner and end of a lease; a lease that has just been made and says nothing yet ends with its time."""
        if number < 0 or hadoop.exists(self.spark, self._path(number, ".done")):
            return "", 0.0
        text = hadoop.read_text(self.spark, self._path(number, ".until")) or hadoop.read_text(self.spark, self._path(number))
        try:
            said = json.loads(text)
            return said["owner"], float(said["until"])
        except (ValueError, KeyError, TypeError):
            made = hadoop.modified(self.spark, self._path(number))
            return "a run that has just begun", made + self.seconds

    def _said(self) -> str:
        return json.dumps({"owner": self.owner, "until": time.time() + self.seconds})

    def take(self) -> None:
        if (scheme := hadoop.scheme(self.spark, self.folder)) not in EXCLUSIVE:
            raise NoLease(f"files of {scheme} are not made exclusively; run with lease_seconds=None and one run at a time")
        last = self._highest()
        owner, until = self._held_until(last)
        if until > time.time():
            raise LeaseHeld(f"{owner} has {self.folder} until {time.ctime(until)}")
        if not hadoop.create_exclusively(self.spark, self._path(last + 1), self._said()):
            raise LeaseHeld(f"another run has taken {self.folder} just now")
        self.number = last + 1
        for old in range(max(0, last - 9), last):  # the one before stays, as others may have just seen it
            for mark in ("", ".until", ".done"):
                hadoop.delete(self.spark, self._path(old, mark))

    def renew(self) -> None:
        self.check()
        hadoop.write_text(self.spark, self._path(self.number, ".until"), self._said())

    def check(self) -> None:
        if self._highest() != self.number:
            raise LeaseLost(f"another run has taken {self.folder}")

    def give_back(self) -> None:
        if self.number >= 0 and self._highest() == self.number:
            hadoop.write_text(self.spark, self._path(self.number, ".done"), self.owner)


@contextmanager
def leased(spark: SparkSession, folder: str, seconds: float | None) -> Iterator[Lease | None]:
    """The lease for the time of a block, renewed at a third of its time; no lease with ``seconds`` None."""
    if seconds is None:
        yield None
        return
    lease = Lease(spark, folder, seconds)
    lease.take()
    over = threading.Event()

    def keep() -> None:
        while not over.wait(seconds / 3):
            try:
                lease.renew()
            except LeaseLost:
                return

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield lease
    finally:
        over.set()
        keeper.join()
        lease.give_back()
