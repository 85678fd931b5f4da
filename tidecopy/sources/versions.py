"""Versioned folders and leases: how a load is published, and who may load.

Everything a load writes goes to a folder of its own run,

    <database folder>/_tidecopy/<table>/v/<fence>_<id>

and becomes the table's content by a change of a pointer in the catalog (the table's
location, or those of the partitions it replaces). No file is moved or overwritten, so
a query that has listed the old files reads them to its end; they are deleted by a
later load, ``KEEP_SECONDS`` after they were replaced.

A load holds the table's lease: a file ``lease/<n>``, created if absent and kept alive
by a heartbeat. Its number, the fence, grows with every holder. A second run waits
for the lease or is refused; one that finds it expired takes the next number, and
the run that had it can't publish any more. What a run left is only touched by a
later holder of the lease, and only if it lies in the table's own folder.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import SparkSession

LEASE_SECONDS = 120        # a lease without a heartbeat for so long is free
KEEP_SECONDS = 3600        # how long replaced files stay for queries that read them
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class LeaseHeld(RuntimeError):
    """Another run loads this table."""


class LeaseLost(RuntimeError):
    """The lease expired and another run took it: nothing may be published."""


class Files:
    """The few file operations that leases and versions need, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def names(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def folders(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def glob(self, pattern: str) -> list[str]:
        fs, p = self._at(pattern)
        return [s.getPath().toString() for s in fs.globStatus(p) or []]

    def make(self, folder: str) -> None:
        fs, p = self._at(folder)
        fs.mkdirs(p)

    def modified(self, path: str) -> float:
        fs, p = self._at(path)
        return fs.getFileStatus(p).getModificationTime() / 1000

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        size = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(size)).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, *, new: bool = False) -> bool:
        """Write a small file; with ``new`` only if there is none (False if there is)."""
        fs, p = self._at(path)
        try:
            stream = fs.create(p, not new)
        except Exception:
            if new and fs.exists(p):
                return False
            raise
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return True

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


@dataclass
class Lease:
    """A held lease; ``fence`` is its number."""

    files: Files | None
    root: str
    fence: int
    seconds: float
    run: str = field(default_factory=lambda: uuid.uuid4().hex[:8])
    published: list = field(default_factory=list)      # (folder, only its partitions) of this run
    _stop: threading.Event = field(default_factory=threading.Event)
    _made: int = 0

    def _beat(self) -> None:
        while not self._stop.wait(self.seconds / 3):
            try:
                self.files.write(f"{self.root}/lease/{self.fence:012d}.beat", json.dumps(_until(self.seconds)))
            except Exception:  # the lease then runs out, and ``check`` stops the run
                pass

    def check(self) -> None:
        """Raise unless this run still holds the lease; called before anything is published."""
        if self.files is None:
            return
        numbers = _numbers(self.files, self.root)
        if not numbers or numbers[-1] != self.fence or _ended(self.files, self.root, self.fence):
            raise LeaseLost(f"the lease {self.fence} of {self.root} has expired or is another run's")

    def version(self) -> str:
        """A new folder for rows that this run writes."""
        self._made += 1
        return f"{self.root}/v/{self.fence:012d}_{self.run}_{self._made:04d}"

    def retire(self, paths: list[str]) -> None:
        """Note folders that nothing points to any more."""
        if self.files is not None and paths:
            self.files.write(f"{self.root}/retired/{int(time.time() * 1000)}_{uuid.uuid4().hex[:8]}", "\n".join(paths))

    def discard(self, path: str) -> None:
        """Delete a folder of this run that was not published."""
        if self.files is not None:
            self.files.delete(path)


def _until(seconds: float) -> dict:
    return {"until": time.time() + seconds}


def _numbers(files: Files, root: str) -> list[int]:
    return sorted(int(n) for n in files.names(f"{root}/lease") if n.isdigit())


def _ended(files: Files, root: str, number: int) -> bool:
    at = f"{root}/lease/{number:012d}"
    if files.exists(f"{at}.done"):
        return True
    for path in (f"{at}.beat", at):
        try:
            return json.loads(files.read(path))["until"] < time.time()
        except Exception:  # not there, or just being written
            continue
    try:  # left empty by a run that died at once
        return files.modified(at) + LEASE_SECONDS < time.time()
    except Exception:
        return False


def take(files: Files, root: str, *, seconds: float = LEASE_SECONDS, wait: float = 0.0) -> Lease:
    """Take the lease of ``root``, waiting up to ``wait`` seconds for another run's end."""
    limit = time.time() + wait
    while True:
        numbers = _numbers(files, root)
        last = numbers[-1] if numbers else 0
        if not last or _ended(files, root, last):
            if files.write(f"{root}/lease/{last + 1:012d}", json.dumps(_until(seconds)), new=True):
                lease = Lease(files, root, last + 1, seconds)
                threading.Thread(target=lease._beat, daemon=True).start()
                return lease
        elif time.time() >= limit:
            raise LeaseHeld(f"another run holds the lease {last} of {root}")
        else:
            time.sleep(min(0.2, max(0.01, limit - time.time())))


def release(lease: Lease) -> None:
    lease._stop.set()
    if lease.files is None:
        return
    lease.files.write(f"{lease.root}/lease/{lease.fence:012d}.done", "")
    for name in lease.files.names(f"{lease.root}/lease"):
        if int(re.match(r"\d+", name).group()) < lease.fence:
            lease.files.delete(f"{lease.root}/lease/{name}")


_HELD = threading.local()


def holding(name: str) -> Lease | None:
    """The lease of a table that this thread holds."""
    return _HELD.__dict__.get("leases", {}).get(name.lower())


@contextmanager
def held(spark: SparkSession, name: str, root: str, *, seconds: float = LEASE_SECONDS, wait: float = 0.0, on_take=None):
    """The lease of a table for the block; blocks inside it, in the same thread, find it by ``holding``.
    ``on_take(lease)`` runs first. Without a JVM at hand (Spark Connect) there is none."""
    try:
        files = Files(spark)
    except Exception:
        files = None
    lease = take(files, root, seconds=seconds, wait=wait) if files else Lease(None, root, time.time_ns() // 10**6, seconds)
    leases = _HELD.__dict__.setdefault("leases", {})
    leases[name.lower()] = lease
    try:
        if on_take and files:
            on_take(lease)
        yield lease
    finally:
        del leases[name.lower()]
        release(lease)


def partitions_in(files: Files, folder: str, depth: int) -> list[str]:
    """Partition folders below ``folder``, as ``a=1/b=2``."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}" if f else n for f in found for n in files.folders(f"{folder}/{f}" if f else folder) if "=" in n]
    return found


def partition_spec(path: str) -> str:
    """``a=1/b=x%3D`` as a partition specification of SQL."""
    out = []
    for part in path.split("/"):
        name, value = part.split("=", 1)
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        out.append(f"`{unquote(name)}` = " + ("null" if value == NULL_PARTITION else f"'{text}'"))
    return f"PARTITION ({', '.join(out)})"
