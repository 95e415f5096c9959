"""Compaction of a store: deltas of like size become larger ones, and in the end buckets of the compacted tables.

The work is done beside the writer, on files that are never changed.  Only the swap takes the lease: a new manifest names the result
in place of what it was made of.  A crash before leaves files that no manifest names; if what was read has been replaced meanwhile, the result is
thrown away.  So the state that a reader sees is the same before, during and after.

A row is rewritten once for each tier of FAN and once more when it is folded, so what compaction writes is the commits' own size times
their tiers, and the table's size over FOLD_SHARE.
"""

from __future__ import annotations

import datetime
import json
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from .manifest import Manifest, StoreBusy
from .snapshot import BUCKET, JOURNAL, TABLES, Store

#: Deltas, or segments of the journal, of one tier that become one of the next.
FAN = 8
#: Deltas are folded when their rows are this share of the compacted tables', or there are no such tables.
FOLD_SHARE = 0.25
#: Commits before the first fold; smaller stores stay in deltas.
FOLD_COMMITS = 64
#: Ids of a journal's segment that grows no further.
SEGMENT_IDS = 1 << 16
#: Pieces of work after which files that no one can read any more are removed.
VACUUM_EVERY = 64


def tier(size: int) -> int:
    n = 0
    while size >= FAN:
        size, n = size // FAN, n + 1
    return n


def run_of(sizes: list[int]) -> tuple[int, int] | None:
    """The first run of FAN neighbours of one tier, from the end back: larger ones come first."""
    for end in range(len(sizes), FAN - 1, -1):
        if len({tier(s) for s in sizes[end - FAN : end]}) == 1:
            return end - FAN, end
    return None


@dataclass
class Compactor:
    store: Store
    #: What has been done, for a report: kind, parts, rows.
    done: list[tuple[str, int, int]] = field(default_factory=list)

    def step(self, before_swap: Callable[[], None] = lambda: None) -> str | None:
        """The most useful piece of work, if any: "fold", "merge", "journal".  A lost race is no error; the next step sees the new state."""
        m = self.store.manifest()
        try:
            if self._fold_due(m):
                return self._fold(m, before_swap)
            if at := run_of([d["commits"] for d in m.deltas]):
                return self._merge(m, *at, before_swap)
            if at := run_of([s["high"] - s["low"] + 1 if s["high"] - s["low"] + 1 < SEGMENT_IDS else -i for i, s in enumerate(m.journal)]):
                return self._journal(m, *at, before_swap)
        except StoreBusy:
            return None
        return None

    def run(self, most: int = 1000) -> int:
        """Steps until nothing is left to do."""
        n = 0
        while n < most and self.step():
            n += 1
        return n

    def _fold_due(self, m: Manifest) -> bool:
        new, old = sum(d["rows"] for d in m.deltas), sum(p["rows"] for p in [*m.blocks.values(), *m.logs.values()])
        return sum(d["commits"] for d in m.deltas) >= FOLD_COMMITS and new >= FOLD_SHARE * old

    def _merge(self, m: Manifest, low: int, high: int, before_swap: Callable[[], None]) -> str | None:
        store, some = self.store, m.deltas[low:high]
        base, made = store.folder("tier"), {"blocks": None, "logs": None}
        for table, (schema, _, _, order) in TABLES.items():
            if any(d[table] for d in some):
                rows = store.merged(table, [], some).select(*(c.split()[0] for c in schema.split(", ")), "seq")
                rows.coalesce(1 + sum(d["rows"] for d in some) // 1_000_000).sortWithinPartitions(*order).write.parquet(f"{store.path}/{base}/{table}")
                made[table] = f"{base}/{table}"
        one = {
            "first": some[0]["first"], "last": some[-1]["last"], "commits": sum(d["commits"] for d in some), "rows": sum(d["rows"] for d in some), "low": min(d["low"] for d in some),
            "high": max(d["high"] for d in some), "fresh": all(d["fresh"] for d in some),
        } | made

        def swap(now: Manifest) -> bool:
            at = next((i for i in range(len(now.deltas)) if now.deltas[i : i + len(some)] == some), None)
            if at is None:
                return False
            now.deltas[at : at + len(some)] = [one]
            return True

        return self._swapped("merge", len(some), one["rows"], swap, before_swap)

    def _fold(self, m: Manifest, before_swap: Callable[[], None]) -> str | None:
        """All deltas into the buckets that they touch, a job a table."""
        store, deltas, base = self.store, list(m.deltas), self.store.folder("base")
        buckets = sorted({b for d in deltas for b in range(d["low"] // BUCKET, d["high"] // BUCKET + 1)})
        made: dict[str, dict[str, dict]] = {}
        for table, (schema, _, height, order) in TABLES.items():
            parts = [p for b, p in getattr(m, table).items() if int(b) in buckets]
            rows = store.merged(table, parts, deltas).select(*(c.split()[0] for c in schema.split(", ")))
            rows = rows.withColumn("bucket", F.floor(F.col(height) / BUCKET))
            rows.repartitionByRange("bucket", *order).sortWithinPartitions("bucket", *order).write.partitionBy("bucket").parquet(f"{store.path}/{base}/{table}")
            sizes = store.spark.read.schema(f"{schema}, bucket bigint").parquet(f"{store.path}/{base}/{table}").groupBy("bucket")
            found = sizes.agg(F.count("*").alias("rows"), F.min(height).alias("low"), F.max(height).alias("high")).collect()  # a row a bucket
            made[table] = {str(r["bucket"]): {"folder": f"{base}/{table}/bucket={r['bucket']}", "rows": r["rows"], "low": r["low"], "high": r["high"]} for r in found}
        old = {t: {b: p for b, p in getattr(m, t).items() if int(b) in buckets} for t in TABLES}

        def swap(now: Manifest) -> bool:
            if now.deltas[: len(deltas)] != deltas or any({b: p for b, p in getattr(now, t).items() if int(b) in buckets} != old[t] for t in TABLES):
                return False
            now.deltas = now.deltas[len(deltas) :]
            for t in TABLES:
                getattr(now, t).update(made[t])
            return True

        return self._swapped("fold", len(deltas), sum(p["rows"] for t in made.values() for p in t.values()), swap, before_swap)

    def _journal(self, m: Manifest, low: int, high: int, before_swap: Callable[[], None]) -> str | None:
        store, some, folder = self.store, m.journal[low:high], self.store.folder("journal")
        store.read([s["folder"] for s in some], JOURNAL).coalesce(1).sortWithinPartitions("event_id").write.parquet(f"{store.path}/{folder}")
        one = {"folder": folder, "low": some[0]["low"], "high": some[-1]["high"]}

        def swap(now: Manifest) -> bool:
            at = next((i for i in range(len(now.journal)) if now.journal[i : i + len(some)] == some), None)
            if at is None:
                return False
            now.journal[at : at + len(some)] = [one]
            return True

        return self._swapped("journal", len(some), one["high"] - one["low"] + 1, swap, before_swap)

    def _swapped(self, kind: str, parts: int, rows: int, swap: Callable[[Manifest], bool], before_swap: Callable[[], None]) -> str | None:
        before_swap()
        with self.store.lease() as lease:
            now = self.store.manifest()
            if not swap(now):
                return None
            self.store.publish(now, lease)
        self.done.append((kind, parts, rows))
        if len(self.done) % VACUUM_EVERY == 0:
            vacuum(self.store)
        return kind


@dataclass
class Background:
    """A compactor in a thread of its own, as a context beside a live run; an error ends it and is raised at the end."""

    compactor: Compactor
    seconds: float = 5.0

    def __enter__(self) -> Background:
        self._stop, self.error = threading.Event(), None
        self._thread = threading.Thread(target=self._work, daemon=True)
        self._thread.start()
        return self

    def _work(self) -> None:
        try:
            while not self._stop.is_set():
                if not self.compactor.step():
                    self._stop.wait(self.seconds)
        except Exception as e:
            self.error = e

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()
        if self.error:
            raise self.error


def vacuum(store: Store, older: datetime.timedelta = datetime.timedelta(hours=1)) -> list[str]:
    """Remove folders that no readable version of the manifest names and that are older than any reader or writer at work."""
    wanted = set()
    for n in store.versions.numbers():
        text = store.files.read(f"{store.versions.folder}/{n:012d}.json")
        wanted |= {name.split("/")[0] for name in _names(json.loads(text))} if text else set()
    least, gone = (datetime.datetime.now() - older).timestamp() * 1000, []
    for s in store.files.fs.listStatus(store.files.at(store.path)):
        name = s.getPath().getName()
        if s.isDirectory() and name not in ("manifests", "leases") and name not in wanted and s.getModificationTime() < least:
            store.files.remove(f"{store.path}/{name}")
            gone.append(name)
    return sorted(gone)


def _names(m: dict) -> set[str]:
    out = {p["folder"] for t in ("blocks", "logs") for p in m[t].values()} | {s["folder"] for s in m["journal"]}
    out |= {d[t] for d in m["deltas"] for t in ("blocks", "logs") if d[t]}
    return out | ({m["marks_folder"]} if m["marks_folder"] else set())
