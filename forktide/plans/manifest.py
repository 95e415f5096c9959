"""The manifest of a store, its versions, and the lease of its writer.

A version is a file of its own, ``manifests/<version>.json``, that can be made once: the writer writes it under another name and then links or
renames it to a name that must be free.  That step is the commit.  A writer that was paused, lost its lease and goes on finds its version
taken and fails; whatever it wrote is named by no manifest.  Readers take the highest version and keep to it.

The lease keeps writers from working in vain; the versions alone keep them from harm.  It has an owner, a token that grows with
every lease, and an expiry; whoever finds it expired moves it away and takes the next token.  Nothing is removed by hand.

On HDFS a rename to a free name is atomic, on local disks a hard link; an object store has to offer puts under the condition that
there is no such object.
"""

from __future__ import annotations

import contextlib
import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

#: Of the tables' schemas and the manifest.
SCHEMA_VERSION = 2
#: Versions that stay readable for readers that have begun.
KEPT_VERSIONS = 16


class StoreError(RuntimeError):
    pass


class StoreBusy(StoreError):
    """Another writer holds the store or has just committed; the same commit may be tried again."""


@dataclass
class Manifest:
    version: int = 0
    chain_id: int | None = None
    genesis_hash: str | None = None
    checkpoint: dict | None = None
    next_event_id: int = 1
    #: Compacted tables: bucket of heights -> folder, low and high height, rows.
    blocks: dict[str, dict] = field(default_factory=dict)
    logs: dict[str, dict] = field(default_factory=dict)
    #: Commits that are not yet part of those, oldest first: seq (first and last), folders, low and high height, rows, fresh.
    deltas: list[dict] = field(default_factory=list)
    #: Segments of the journal in the order of their ids: folder, low, high.
    journal: list[dict] = field(default_factory=list)
    #: Every id up to here is published; beyond it these ranges are.
    published_upto: int = 0
    ahead: list[list[int]] = field(default_factory=list)
    #: When ids were published: low, high, microseconds; earlier ranges are in a table.
    marks: list[list[int]] = field(default_factory=list)
    marks_folder: str | None = None
    #: Of the lease under which this version was made.
    token: int = 0
    schema_version: int = SCHEMA_VERSION


class Files:
    """What the store needs of the file system that holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at(path).getFileSystem(self.conf)
        self.path = path
        self.local = self.fs.getScheme() == "file"

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def read(self, path: str) -> str | None:
        p = self.at(path)
        try:
            stream = self.fs.open(p)
        except Exception as e:
            if "FileNotFound" in str(e):
                return None
            raise
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def make(self, path: str, text: str) -> bool:
        """Make a file with this text, whole or not at all; false if the name is taken."""
        temporary = f"{path[: path.rindex('/')]}/.new-{uuid.uuid4().hex}"
        out = self.fs.create(self.at(temporary), True)
        try:
            out.write(text.encode())
            out.hsync()
        finally:
            out.close()
        try:
            if self.local:
                os.link(self._local(temporary), self._local(path))
                return True
            return self.fs.rename(self.at(temporary), self.at(path))
        except FileExistsError:
            return False
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            self.fs.delete(self.at(temporary), False)

    def _local(self, path: str) -> str:
        return self.fs.makeQualified(self.at(path)).toUri().getPath()

    def move(self, path: str, to: str) -> bool:
        try:
            return self.fs.rename(self.at(path), self.at(to))
        except Exception as e:
            if "FileNotFound" in str(e):
                return False
            raise

    def names(self, path: str) -> list[str]:
        p = self.at(path)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def remove(self, path: str) -> None:
        self.fs.delete(self.at(path), True)


class Versions:
    def __init__(self, files: Files):
        self.files, self.folder = files, f"{files.path}/manifests"
        files.fs.mkdirs(files.at(self.folder))

    def numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names(self.folder) if n.endswith(".json"))

    def load(self, number: int) -> Manifest | None:
        text = self.files.read(f"{self.folder}/{number:012d}.json")
        if text is None:
            return None
        found = json.loads(text)
        if found.get("schema_version") != SCHEMA_VERSION:
            raise StoreError(f"the store has schema {found.get('schema_version')}, this code {SCHEMA_VERSION}")
        return Manifest(**found)

    def latest(self) -> Manifest:
        if self.files.fs.exists(self.files.at(f"{self.files.path}/manifest.json")):
            raise StoreError(f"the store has schema 1, this code {SCHEMA_VERSION}")
        for _ in range(KEPT_VERSIONS):
            numbers = self.numbers()
            if not numbers:
                return Manifest()
            if (found := self.load(numbers[-1])) is not None:
                return found
        raise StoreBusy("versions of the manifest come faster than they can be read")

    def publish(self, m: Manifest) -> None:
        """Make the next version; another writer's version of that number is an error."""
        m.version += 1
        if not self.files.make(f"{self.folder}/{m.version:012d}.json", json.dumps(asdict(m))):
            raise StoreBusy(f"another writer has made version {m.version}")
        for n in self.numbers()[:-KEPT_VERSIONS]:
            self.files.remove(f"{self.folder}/{n:012d}.json")


@dataclass
class Lease:
    """A writer's lease as a context; ``hold()`` fails once it is another's."""

    files: Files
    seconds: float = 600.0
    #: How long to wait for another writer.
    patience: float = 5.0
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    token: int = 0

    @property
    def path(self) -> str:
        return f"{self.files.path}/.writer"

    def _found(self) -> dict | None:
        text = self.files.read(self.path)
        return json.loads(text) if text else None

    def __enter__(self) -> Lease:
        owner, until, last = uuid.uuid4().hex, self.clock() + self.patience, 0
        while True:
            last = max([last, *(int(n) for n in self.files.names(f"{self.files.path}/leases"))])
            self.token = last + 1
            if self.files.make(self.path, json.dumps({"token": self.token, "owner": owner, "expires": self.clock() + self.seconds})):
                self.owner = owner
                return self
            found = self._found()
            if found and found["expires"] < self.clock():
                self.files.fs.mkdirs(self.files.at(f"{self.files.path}/leases"))
                if self.files.move(self.path, f"{self.files.path}/leases/{found['token']}"):
                    last = found["token"]
                continue
            if self.clock() >= until:
                raise StoreBusy("another writer holds the store")
            self.sleep(0.05)

    def hold(self) -> None:
        found = self._found()
        if found is None or found["owner"] != self.owner:
            raise StoreBusy("the lease has gone to another writer")

    def __exit__(self, *_) -> None:
        with contextlib.suppress(StoreBusy):
            self.hold()
            self.files.remove(self.path)
