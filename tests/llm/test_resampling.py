"""Importance resampling against a plain draw; its tournament trees; hot and tied rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from forktide.llm import resampling
from forktide.llm.common import bounded_batches

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_draw(rows, target, rate=10, buckets=10_000, seed=2024, least=20):
    """(doc_id, n_features, weight, score) of every row, and the ranks of the drawn in order."""
    at = (lambda w: zlib.crc32(w.encode()) % buckets)
    s, t = Counter(at(w) for _, x in rows for w in fold(x)), Counter(at(w) for x in target for w in fold(x))
    ns, nt = float(sum(s.values())), float(sum(t.values()))
    gain = {b: math.floor(1000 * math.log(((t[b] + 1) * (ns + buckets)) / ((s[b] + 1) * (nt + buckets)))) for b in s}
    out = []
    for d, x in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[at(w)] for w in fold(x))
        out.append((d, len(fold(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return Counter(out), [(*r, k + 1) for k, r in enumerate(eligible[: rate * len(eligible) // 100])]


def checked(spark, path, rows, target, **options):
    out = [tuple(r) for r in resampling.importance_resample(spark.read.parquet(f"{path}/documents.parquet"), spark.createDataFrame([(x,) for x in target], "text string"), **options).collect()]
    want, drawn = plain_draw(rows, target, options.get("rate", 10))
    assert Counter(r[:4] for r in out) == want
    assert sorted((r for r in out if r[4] is not None), key=lambda r: r[4]) == drawn
    return drawn


def texts(n, seed=3):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(["Wort", "mot", "palabra", "été", "x1", "THE", "the", "z_z"]) for _ in range(rnd.randint(5, 60))) for _ in range(n)]


def test_draw_equals_a_plain_one(spark, table_dir):
    rows = list(enumerate(texts(400)))
    assert len(checked(spark, table_dir(rows), rows, ["mot mot palabra", None, "THE end"])) > 20


def test_nulls_ties_repeated_rows_and_no_target(spark, table_dir):
    bounded_batches(spark)
    long = "one two three " * 200_000
    rows = [(None, texts(1)[0] * 3), (None, None), (1, ""), (2, long), *[(5, texts(1, 9)[0] * 4)] * 60, *[(None, "word " * 30)] * 40, *enumerate(texts(60), 100)]
    checked(spark, table_dir(rows), rows, [])
    checked(spark, table_dir(rows), rows, ["word"], rate=50)
    assert checked(spark, table_dir(rows), rows, ["word"], rate=0) == []
    assert len(checked(spark, table_dir(rows), rows, ["word"], rate=100)) > 100


def test_many_ranges_and_runs(spark, table_dir, monkeypatch):
    monkeypatch.setattr(resampling, "RANGE_ROWS", 7)
    monkeypatch.setattr(resampling, "BLOCK_ROWS", 3)
    rows = list(enumerate(texts(500, 4)))
    checked(spark, table_dir(rows), rows, ["mot"], rate=35)


def test_an_empty_table_and_clashing_names(spark, tmp_path):
    for rows in ([], [(1, "a b c", 5, "x")]):
        spark.createDataFrame(rows, "doc_id long, text string, score long, rank string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([("a",)], "text string").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
        out = resampling.op11_importance_resampling(spark, str(tmp_path)).collect()
        assert [(r["doc_id"], r["n_features"], r["rank"]) for r in out] == [(1, 3, None)] * len(rows)


def test_longer_runs_of_words():
    n, ids = resampling.bucket_ids(b"One two, ONE two", 1000, 2)
    want = [zlib.crc32(w) % 1000 for w in (b"one", b"two", b"one", b"two", b"one two", b"two one", b"one two")]
    assert n == 4 and ids.tolist() == want


def test_tournament_takes_players_while_it_runs():
    rnd, tree, runs, out = random.Random(2), resampling.Tournament(), {}, []
    fresh = [sorted(rnd.sample(range(10_000), rnd.randint(1, 30))) for _ in range(37)]
    for run in sorted(fresh):  # a run joins when all before its head is out
        while (first := tree.first())[1] is not None and first[1] < (run[0],):
            player = first[0]
            out.append(first[1][0])
            tree.show(player, (runs[player].pop(0),) if runs[player] else None)
        player = tree.join()
        runs[player] = run[1:]
        tree.show(player, (run[0],))
    while (first := tree.first())[1] is not None:
        out.append(first[1][0])
        tree.show(first[0], (runs[first[0]].pop(0),) if runs[first[0]] else None)
    assert out == sorted(x for run in fresh for x in run)


def test_gains_are_floors():
    assert resampling.gains(np.array([0, 5]), np.array([0, 0])).tolist() == [math.floor(1000 * math.log(7 / 2)), math.floor(1000 * math.log(7 / 12))]
