"""Byte deduplication against brute force, its sort against sorted(), hot buckets at every level."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from forktide.llm import byte_dedup, suffix_sort


def plain_removal(rows):
    rows = [(d, (t or "").encode()) for d, t in rows]
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1]).digest())):
        gone = bytearray(len(t))
        for k in range(len(t) - 99):
            w = t[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((d, len(t), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return Counter(out)


def hard_rows():
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh é") for _ in range(900))
    around = (lambda: "".join(rnd.choice("xyzw ") for _ in range(rnd.randint(0, 200))))
    rows = []
    for i in range(250):
        a, b = sorted(rnd.sample(range(900), 2))
        rows.append((rnd.choice([i, i, i, None, 3, 4]), around() + (passage if i % 7 == 0 else passage[a:b]) + around()))
    edges = [(7, "ab" * 400), (7, "ab" * 400), (8, "a" * 99), (8, "a" * 99), (9, "z" * 1000), (None, None), (None, "q" * 150), (None, "q" * 150), (10, ""), (11, "z" * 300), (12, "é" * 120), (13, "x" + "é" * 80)]
    return rows + edges + [(20, passage)] * 40 + [(21, passage)] * 3


@pytest.mark.parametrize("bucket", [512, 8, 2])
def test_removal_equals_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(byte_dedup, "BUCKET", bucket)  # small ones are dealt again, by a second minimiser and by windows
    rows = hard_rows()
    out = byte_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_spans"], bytes(r["kept"])) for r in out.collect()) == plain_removal(rows)


def test_what_a_task_remembers_is_no_bound(spark, monkeypatch):
    monkeypatch.setattr(byte_dedup, "REMEMBERED", 5)
    monkeypatch.setattr(byte_dedup, "SORTED", 100)
    monkeypatch.setattr(byte_dedup, "TOGETHER", 500)  # long texts come in parts
    rows = hard_rows()[:120] + [(500, "".join(random.Random(1).choices("ab c", k=6000)) * 2)]
    out = byte_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_spans"], bytes(r["kept"])) for r in out.collect()) == plain_removal(rows)


def test_clashing_names_an_empty_table_and_a_long_text(spark, table_dir):
    schema = "doc_id long, text string, hits string, first string, copy string, start long, mask long"
    long = "".join(random.Random(2).choices("abcdefghij ", k=1_000_000))
    path = table_dir([(1, long, *"abc", 1, 2), (2, long[500_000:] + "!", *"abc", 1, 2)], schema=schema)
    out = {r["doc_id"]: r for r in byte_dedup.op12_suffix_dedup(spark, path).collect()}
    assert out[1]["n_removed"] == 0 and (out[2]["n_removed"], out[2]["n_spans"], out[2]["kept_sha256"]) == (500_000, 1, hashlib.sha256(b"!").hexdigest())
    assert byte_dedup.op12_suffix_dedup(spark, table_dir([], schema=schema)).count() == 0
    same = byte_dedup.op12_suffix_dedup(spark, table_dir([(1, "a" * 100_000, *"abc", 1, 2)], schema=schema)).first()
    assert (same["n_removed"], same["n_spans"]) == (99_999, 1)


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefghij", bytes(range(256))])
def test_windows_in_order(alphabet):
    rnd = random.Random(len(alphabet))
    for case in range(12):
        parts, starts, sizes, at = [], [], [], 0
        passages = [bytes(rnd.choice(alphabet) for _ in range(300)) for _ in range(3)]
        for _ in range(rnd.randint(1, 4)):
            n = 0
            for _ in range(rnd.randint(1, 30 if case else 120)):
                begin = rnd.randint(0, 100)
                s = bytearray(rnd.choice(passages)[begin : begin + rnd.randint(100, 170)])
                if rnd.random() < 0.5:
                    s[rnd.randrange(len(s))] = rnd.choice(alphabet)
                windows = len(s) - 99
                starts += range(at, at + windows)
                n, at = n + windows, at + len(s)
                parts.append(bytes(s))
            sizes.append(n)
        data, low = b"".join(parts) + bytes(suffix_sort.CHAR), 0
        order, cls = suffix_sort.equal_windows(data, np.array(starts), np.array(sizes))
        for n in sizes:
            own, number = order[low : low + n].tolist(), cls[low : low + n].tolist()
            found = [data[i : i + 100] for i in own]
            assert sorted(own) == sorted(starts[low : low + n]) and found == sorted(found)
            assert all((number[i] == number[i + 1]) == (found[i] == found[i + 1]) for i in range(n - 1))
            low += n


def test_a_trie_finds_the_first_byte_that_differs():
    base = bytes(range(100)) * 1
    windows = [base, base[:50] + b"\xff" + base[51:], base[:50] + b"\x00" + base[51:], base[:99] + b"\xff", base, b"\xff" + base[1:]]
    data = b"".join(windows)
    trie = suffix_sort.BlindTrie(data, 0)
    for k in range(1, len(windows)):
        trie.insert(100 * k)
    leaves = trie.leaves()
    assert [data[x[0] : x[0] + 100] for x in leaves] == sorted(set(windows)) and sorted(map(len, leaves)) == [1, 1, 1, 1, 2]
