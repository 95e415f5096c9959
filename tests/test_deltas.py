"""Commits by deltas: what they write, what readers see, compaction, crashes at every step, leases."""

import datetime
import os
import random
import signal
import subprocess
import sys

import pytest
from test_store import FORK, MAIN, advance, canonical, header, hx, rows, store  # noqa: F401

from forktide.operators import merge
from forktide.operators.transition import Batch, Event, Header
from forktide.plans import compaction, snapshot
from forktide.plans.compaction import Background, Compactor, vacuum
from forktide.plans.manifest import Lease
from forktide.plans.snapshot import BLOCKS, LOGS, Store, StoreBusy, StoreError


def block(branch, height):
    return f"{branch:02x}{height:062x}"


def chain(branch, low, high, below):
    return [Header(block(branch, h), below if h == low else block(branch, h - 1), h) for h in range(low, high + 1)]


def state(s):
    """All that readers see but for times."""
    blocks = sorted((r["block_hash"], r["parent_hash"], r["height"], r["is_canonical"], r["status"]) for r in s.blocks().collect())
    logs = sorted((r["block_hash"], r["log_index"], r["data"], r["decoded_event"] or "", r["decoder_version"] or "") for r in s.logs().collect())
    return blocks, logs, sorted((r["event_id"], r["event_kind"], r["block_hash"], r["payload"]) for r in s.journal().collect()), s.checkpoint()


def random_batches(seed, n):
    """A history of extensions and reorganisations, and the canonical chain after it."""
    rnd, at, out, branch = random.Random(seed), chain(0, 0, 0, "f" * 64), [], 0
    out.append(Batch("bootstrap", None, (Event("apply", at[0]),)))
    old = []
    for _ in range(n):
        if len(at) > 3 and rnd.random() < 0.4:
            depth = rnd.randint(1, 3)
            keep, gone = at[:-depth], at[-depth:]
            if old and old[-1][0].parent_hash == keep[-1].block_hash and rnd.random() < 0.7:
                new = old.pop()  # back to a branch that was left
            else:
                branch += 1
                new = chain(branch, keep[-1].height + 1, keep[-1].height + depth + 1, keep[-1].block_hash)
            out.append(Batch("reorg", keep[-1], (*(Event("rollback", h) for h in reversed(gone)), *(Event("apply", h) for h in new))))
            old.append(gone)
            at = keep + new
        else:
            new = [Header(block(branch, at[-1].height + 1), at[-1].block_hash, at[-1].height + 1)]
            out.append(Batch("extend", at[-1], (Event("apply", new[0]),)))
            at = at + new
    return out, at


def apply_all(s, batches, **more):
    for b in batches:
        s.commit(b, *rows(s.spark, [e.header for e in b.events if e.kind == "apply"]), **more)


def test_a_history_reads_the_same_with_and_without_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "FAN", 2)
    monkeypatch.setattr(compaction, "FOLD_COMMITS", 5)
    monkeypatch.setattr(snapshot, "BUCKET", 4)
    monkeypatch.setattr(compaction, "BUCKET", 4)
    batches, at = random_batches(4, 9)
    plain, busy = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    worker = Compactor(busy)
    for b in batches:
        apply_all(plain, [b])
        apply_all(busy, [b])
        worker.step()
    worker.run()
    kinds = {k for k, *_ in worker.done}
    assert kinds == {"merge", "fold", "journal"} and len(busy.manifest().deltas) < len(batches) / 2 and len(busy.manifest().journal) < len(batches)
    assert state(plain) == state(busy) and len(plain.manifest().deltas) == len(batches)
    want = [h.block_hash for h in at]
    for s in (plain, busy):
        assert [r["block_hash"] for r in s.blocks().where("is_canonical").orderBy("height").collect()] == want
        assert s.blocks(3, 5).count() == s.blocks().where("height BETWEEN 3 AND 5").count() and s.logs(2).count() == s.logs().where("block_number >= 2").count()
        assert not s.blocks().groupBy("block_hash").count().where("count > 1").count() and merge.check_unique(s.blocks()).isEmpty()
    events = [(e.kind, e.header.block_hash) for b in batches for e in b.events]
    assert [(r["event_kind"], r["block_hash"]) for r in busy.journal().orderBy("event_id").collect()] == events


def test_a_commit_writes_its_own_rows_alone(spark, store):  # noqa: F811
    long = chain(0, 0, 199, "f" * 64)
    store.commit(Batch("bootstrap", None, (Event("apply", long[0]),)), *rows(spark, long[:1]))
    store.commit(Batch("gap", long[0], tuple(Event("apply", h) for h in long[1:])), *rows(spark, long[1:]))
    before = {d: folder_size(d) for d in folders(store)}
    extra = chain(0, 200, 202, long[-1].block_hash)
    for below, h in zip([long[-1], *extra], extra):
        store.commit(Batch("extend", below, (Event("apply", h),)), *rows(spark, [h]))
    after = folders(store)
    assert all(folder_size(d) == n for d, n in before.items()) and len(after - before.keys()) == 3
    new = store.manifest().deltas[-1]
    assert new["rows"] == 2 and new["fresh"] and (new["low"], new["high"]) == (202, 202)
    files = store.blocks(202).inputFiles()
    assert len(files) == 1 and new["blocks"] in files[0] and "Join" not in store.blocks()._jdf.queryExecution().toString()


def folders(s):
    return {os.path.join(s.path, n) for n in os.listdir(s.path) if os.path.isdir(os.path.join(s.path, n)) and n not in ("manifests", "leases")}


def folder_size(path):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names)


def test_a_block_that_comes_back_keeps_its_logs(spark, store):  # noqa: F811
    for h in (MAIN[0], MAIN[3]):
        advance(store, spark, h, MAIN)
    advance(store, spark, FORK[1], [*MAIN, *FORK])
    batch = Batch("reorg", MAIN[1], (Event("rollback", FORK[1]), Event("rollback", FORK[0]), Event("apply", MAIN[2]), Event("apply", MAIN[3])))
    blocks, logs = rows(spark, MAIN[2:])
    other = logs.withColumns({"data": snapshot.F.lit("ee"), "decoded_event": snapshot.F.lit("{}"), "decoder_version": snapshot.F.lit("v")})
    store.commit(batch, blocks.withColumn("status", snapshot.F.lit("safe")), other)
    assert canonical(store) == ["00", "01", "02", "03"] and store.logs().count() == 6 and store.blocks().where("status = 'safe'").count() == 2
    kept = {r["block_hash"][:2]: (r["data"], r["decoded_event"]) for r in store.logs().collect()}
    assert kept["02"] == ("02", None) and kept["0c"] == ("0c", None)  # raw fields stay, and a decode of other data is not taken


@pytest.mark.parametrize("change, words", [("log", "lacks its block"), ("twice", "comes twice"), ("unknown", "unknown block"), ("two", "two canonical")])
def test_what_a_commit_refuses(spark, store, change, words):  # noqa: F811
    advance(store, spark, MAIN[0], MAIN)
    before = store.manifest()
    blocks, logs = rows(spark, MAIN[1:2])
    batch = Batch("extend", MAIN[0], (Event("apply", MAIN[1]),))
    if change == "log":
        logs = logs.withColumn("block_number", snapshot.F.lit(7).cast("bigint"))
    if change == "twice":
        logs = logs.unionAll(logs)
    if change == "unknown":
        batch = Batch("reorg", MAIN[0], (Event("rollback", FORK[0]), Event("apply", MAIN[1])))
    if change == "two":
        twin = Header(hx(77), MAIN[0].block_hash, 1)
        batch = Batch("extend", MAIN[0], (Event("apply", MAIN[1]), Event("apply", twin)))
        blocks, logs = rows(spark, [MAIN[1], twin])
    with pytest.raises(StoreError, match=words):
        store.commit(batch, blocks, logs)
    assert store.manifest() == before and canonical(store) == ["00"]


def test_a_crash_in_compaction_changes_nothing(spark, store, monkeypatch):  # noqa: F811
    monkeypatch.setattr(compaction, "FAN", 2)
    monkeypatch.setattr(compaction, "FOLD_COMMITS", 4)
    apply_all(store, random_batches(1, 3)[0])
    before, version = state(store), store.manifest().version

    def die():
        raise KeyboardInterrupt

    for due in ("fold", "merge", "journal"):
        monkeypatch.setattr(compaction.Compactor, "_fold_due", lambda self, m, due=due: due == "fold")
        worker = Compactor(store)
        with pytest.raises(KeyboardInterrupt):
            worker.step(die)
        assert store.manifest().version == version and state(store) == before
        if due == "merge":
            continue
    assert Compactor(store).run() > 0 and state(store) == before
    unnamed = folders(store)
    assert vacuum(store) == [] and len(vacuum(store, datetime.timedelta(seconds=-5))) >= 2 and folders(store) < unnamed and state(store) == before


def test_compaction_beside_commits_loses_no_race(spark, store, monkeypatch):  # noqa: F811
    monkeypatch.setattr(compaction, "FAN", 2)
    monkeypatch.setattr(compaction, "FOLD_COMMITS", 4)
    batches, at = random_batches(6, 7)
    apply_all(store, batches[:4])
    worker = Compactor(store)
    assert worker.step(lambda: apply_all(store, batches[4:5])) in ("fold", "merge")  # a commit amid the work
    monkeypatch.setattr(compaction, "FOLD_COMMITS", 10**9)
    rival = Compactor(store)
    assert worker.step(lambda: rival.step()) is None  # a rival has replaced what was read
    with Background(worker, 0.05):
        apply_all(store, batches[5:])
    assert [r["block_hash"] for r in store.blocks().where("is_canonical").orderBy("height").collect()] == [h.block_hash for h in at]


def test_a_paused_writer_fails_to_publish(spark, tmp_path):
    now = [1000.0]
    slow = Store(spark, str(tmp_path / "s"))
    slow.identify(1, hx(0))
    first = Batch("bootstrap", None, (Event("apply", MAIN[0]),))

    def lease():
        return Lease(slow.files, 60.0, 0.2, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))

    slow.lease = lease
    fast = Store(spark, str(tmp_path / "s"))
    fast.lease = lease

    def paused():
        with pytest.raises(StoreBusy):
            fast.commit(first, *rows(spark, MAIN[:1]))  # the lease holds
        now[0] += 61  # it has run out; nobody removes a file by hand
        fast.commit(first, *rows(spark, MAIN[:1]))

    with pytest.raises(StoreBusy, match="another writer"):
        slow.commit(first, *rows(spark, MAIN[:1]), before_publish=paused)
    m = fast.manifest()
    assert fast.journal().count() == 1 and fast.checkpoint() == MAIN[0] and m.token >= 2
    stale = fast.versions.load(m.version - 1)
    with pytest.raises(StoreBusy, match="has made version"):
        fast.versions.publish(stale)  # even without a lease a version is made once
    second = Batch("extend", MAIN[0], (Event("apply", MAIN[1]),))
    slow.commit(second, *rows(spark, MAIN[1:2]))
    assert slow.checkpoint() == MAIN[1] and not [n for n in os.listdir(slow.path) if n == ".writer"]


def test_versions_of_the_manifest_are_few(spark, store):  # noqa: F811
    for i in range(1, 41):
        store.mark_range(2 * i, 2 * i)
    assert len(store.versions.numbers()) == 16 and store.manifest().ahead[:2] == [[2, 2], [4, 4]] and store.manifest().published_upto == 0
    store.mark_range(1, 79)
    assert store.manifest().published_upto == 80 and store.manifest().ahead == []


CHILD = """
import os, sys
sys.path[:0] = [{root!r}, {tests!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
from test_deltas import random_batches, apply_all
from forktide.plans.snapshot import Store
batches, _ = random_batches(9, 2)
store = Store(spark, {path!r}, lease_seconds=0.0)
apply_all(store, batches[:2])
print("READY", flush=True)
apply_all(store, batches[2:], at_step=lambda step: os.kill(os.getpid(), 9) if step == {step!r} else None)
"""


@pytest.mark.parametrize("step", ["lease", "rows", "journal", "publish"])
def test_a_process_killed_at_each_step_of_a_commit(spark, tmp_path, step):
    """What a killed writer leaves, read and gone on with by another process, equals a clean run's."""
    here = os.path.dirname(os.path.abspath(__file__))
    code = CHILD.format(root=os.path.dirname(here), tests=here, path=str(tmp_path / "s"), step=step)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert "READY" in done.stdout and done.returncode == -signal.SIGKILL, done.stderr[-2000:]
    batches, _ = random_batches(9, 2)
    clean, left = Store(spark, str(tmp_path / "clean")), Store(spark, str(tmp_path / "s"), patience=1.0)
    apply_all(clean, batches[:2])
    if step != "publish":
        assert state(left) == state(clean)
    apply_all(clean, batches[2:])
    apply_all(left, batches[2:])  # what was committed already changes nothing
    assert state(left) == state(clean)


def test_marks_beyond_the_manifest(spark, store, monkeypatch):  # noqa: F811
    monkeypatch.setattr(snapshot, "INLINE_MARKS", 2)
    long = chain(0, 0, 9, "f" * 64)
    store.commit(Batch("bootstrap", None, (Event("apply", long[0]),)), *rows(spark, long[:1]))
    store.commit(Batch("gap", long[0], tuple(Event("apply", h) for h in long[1:])), *rows(spark, long[1:]))
    store.mark_published(spark.createDataFrame([(2,), (3,), (7,), (3,)], "event_id long"))
    first = {r["event_id"]: r["published_at"] for r in store.journal().collect()}
    assert {k for k, v in first.items() if v} == {2, 3, 7} and store.manifest().published_upto == 0
    store.mark_range(1, 4)
    store.mark_range(6, 6)
    again = {r["event_id"]: r["published_at"] for r in store.journal().collect()}
    assert store.manifest().marks_folder and all(again[k] == first[k] for k in (2, 3, 7)) and {k for k, v in again.items() if v} == {1, 2, 3, 4, 6, 7}
    assert (store.manifest().published_upto, store.manifest().ahead) == (4, [[6, 7]])
    assert [r["event_id"] for r in store.pending(store.unpublished()).orderBy("event_id").collect()] == [5, 8, 9, 10]


def test_schemas_of_the_store_agree():
    assert [c.split()[0] for c in BLOCKS.split(", ")][0] == "block_hash" and "decoder_version" in LOGS and header(1, 0).height == 1
