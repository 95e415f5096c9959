"""Packing, the chunk store and the piece model against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd_texts import ODD_TEXTS
from tokenizers import Tokenizer

from forktide.llm import chunk_store, packing, pieces
from forktide.llm.tokens import Encoder, public_path

WORD, BYTE, PIECE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def plain(name, texts):
    t = Tokenizer.from_file(public_path(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows_of(spark, sf_dir):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_chunked_encoding_equals_the_library(name):
    rnd = random.Random(5)
    texts = [*ODD_TEXTS, *("".join(rnd.choice(" \n\t a'sé1,\u0085́") for _ in range(rnd.randint(1, 40))) for _ in range(1000))]
    assert [np.frombuffer(b, "<u4").tolist() for b in Encoder(public_path(name)).encode(texts)] == plain(name, texts)


def check_packing(rows, out):
    ids = {d: x + [packing.END_ID] for (d, _), x in zip(rows, plain(WORD, [t for _, t in rows]))}
    pieces_of, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces_of[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces_of) == set(ids)
    for d, got in pieces_of.items():
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids[d])
            assert r["ids_crc32"] == crc(ids[d][at : at + r["length"]])
            at += r["length"]
        assert at == len(ids[d])
    padding = 0
    for got in sequences.values():
        at = 0
        for r in sorted(got, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH and len(got) <= packing.SEGMENTS and sum(r["loss_tokens"] for r in got) <= packing.LOSS
        padding += 0 if at & (at - 1) == 0 else packing.LENGTH - at
    return padding / sum(map(len, ids.values()))


def test_packing_of_the_table(spark, sf_dir):
    assert check_packing(rows_of(spark, sf_dir), packing.op4_packing(spark, sf_dir).collect()) < 0.01


def test_packing_of_odd_texts(spark, table_dir):
    rows = list(enumerate(ODD_TEXTS))
    check_packing(rows, packing.op4_packing(spark, table_dir(rows)).collect())
    assert packing.op4_packing(spark, table_dir([])).count() == 0


def test_packing_without_cuts_keeps_three_limits():
    rnd = random.Random(3)
    p = packing.Packer(1000, 8, 300, cut=False, waiting=64)
    items = [(n := rnd.randint(1, 900), rnd.randint(0, min(n, 300))) for _ in range(1500)]
    out = [s for i, (n, loss) in enumerate(items) for s in p.add(i, n, loss)] + list(p.finish())
    assert sorted(q.item for s in out for q in s) == list(range(len(items)))
    assert all(sum(q.length for q in s) <= 1000 and len(s) <= 8 and sum(q.loss for q in s) <= 300 for s in out)
    least = max(sum(n for n, _ in items) / 1000, len(items) / 8, sum(x for _, x in items) / 300)
    assert len(out) < 1.25 * least


def check_store(spark, rows, out):
    at = 0
    ids = plain(BYTE, [t for _, t in rows])
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    for (d, _), x in zip(rows, ids):
        x = x + [chunk_store.END_ID]
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(x), crc(x))
        at += len(x)


def test_store_of_the_table(spark, sf_dir):
    check_store(spark, rows_of(spark, sf_dir), chunk_store.op6_chunk_store(spark, sf_dir).collect())


def test_store_of_odd_texts_and_round_trip(spark, table_dir, tmp_path):
    rows = [*enumerate(ODD_TEXTS), (100, "the same passage " * 400), (101, "another start " + "the same passage " * 400)]
    where = table_dir(rows)
    check_store(spark, rows, chunk_store.op6_chunk_store(spark, where).collect())
    assert chunk_store.op6_chunk_store(spark, table_dir([])).count() == 0
    path = str(tmp_path / "store")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunk_store.write_store(docs, path, public_path(BYTE))
    back = {r["doc_id"]: r["ids"] for r in chunk_store.reconstruct(spark, path).collect()}
    assert back == {d: x + [chunk_store.END_ID] for (d, _), x in zip(rows, plain(BYTE, [t for _, t in rows]))}
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    assert chunks.groupBy().sum("n").first()[0] < sum(map(len, back.values()))
    assert len(chunk_store.store_root(spark, path)) == 64


def test_a_damaged_chunk_is_noticed(spark, tmp_path):
    path = str(tmp_path / "store")
    chunk_store.write_store(spark.createDataFrame([(1, "a text of a few words")], "doc_id long, text string"), path, public_path(BYTE))
    chunks = spark.read.parquet(f"{path}/chunks").collect()
    bad = [(r["digest"], r["n"], bytes(r["ids"])[:-1] + b"\x7f") for r in chunks]
    spark.createDataFrame(bad, "digest binary, n int, ids binary").write.mode("overwrite").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="damaged"):
        chunk_store.read_store(spark, path).collect()


def test_appended_crcs():
    rnd = random.Random(1)
    lists = [[rnd.randbytes(4 * rnd.choice([1, 2, 50, chunk_store.MAX_CHUNK])) for _ in range(rnd.randint(1, 6))] for _ in range(20)]
    flat = [x for p in lists for x in p]
    got = chunk_store.crc_of_lists(np.cumsum([len(p) for p in lists]), np.array([zlib.crc32(x) for x in flat]), np.array([len(x) // 4 for x in flat]))
    assert got.tolist() == [zlib.crc32(b"".join(p)) for p in lists]


def test_chunks_of_a_batch_are_those_of_each_document():
    rnd = np.random.default_rng(3)
    docs = [rnd.integers(0, 40000, n).astype("<u4").tobytes() for n in (1, 127, 5000, 3, 20000, 1)]
    docs.append(docs[2])
    docs.append(np.zeros(9000, "<u4").tobytes())
    together = chunk_store.chunk_documents(docs, 2)
    assert together == [chunk_store.chunk_documents([d], 2)[0] for d in docs] and together[6] == together[2]
    for d, c in zip(docs, together):
        assert np.concatenate([np.frombuffer(x, "<u2") for _, x in c]).tolist() == np.frombuffer(d, "<u4").tolist()
        assert all(chunk_store.MIN_CHUNK <= len(x) // 2 for _, x in c[:-1]) and all(len(x) // 2 <= chunk_store.MAX_CHUNK for _, x in c)
    assert [len(x) for c in chunk_store.chunk_documents(docs, 4) for _, x in c] == [2 * len(x) for c in together for _, x in c]


def plain_tree(nodes):
    if len(nodes) == 1:
        return nodes[0]
    half = 1
    while 2 * half < len(nodes):
        half *= 2
    return hashlib.sha256(b"\1" + plain_tree(nodes[:half]) + plain_tree(nodes[half:])).digest()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 21])
def test_merkle_paths(n):
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    root = chunk_store.tree(nodes)
    assert root == plain_tree(nodes)
    assert all(chunk_store.follow(x, chunk_store.path_to(nodes, i)) == root for i, x in enumerate(nodes))


def test_a_document_is_proved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chunk_store, "BLOCK", 4)
    path = str(tmp_path / "store")
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(50)] + [(None, "a"), (None, "a"), (7, "text again"), (7, "text again")]
    chunk_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, public_path(BYTE))
    assert chunk_store.read_store(spark, path).count() == len(rows)
    for d in (0, 7, 23, 49):
        root, way = chunk_store.document_proof(spark, path, d)
        assert chunk_store.follow(chunk_store._leaf(root), way).hex() == chunk_store.store_root(spark, path)
        assert chunk_store.follow(chunk_store._leaf(root[::-1]), way).hex() != chunk_store.store_root(spark, path)


@pytest.fixture(scope="module")
def piece_model():
    return pieces.PieceModel(public_path(PIECE))


def best_sum(m, signed):
    best = [0.0] + [None] * len(signed)
    for end in range(1, len(signed) + 1):
        ways = [best[end - 1] + m.unknown] if signed[end - 1] not in m.pieces else []
        ways += [best[s] + m.pieces[signed[s:end]][1] for s in range(max(0, end - m.longest), end) if signed[s:end] in m.pieces]
        best[end] = max(ways)
    return best[-1]


def test_stream_finds_the_best_sum_and_decodes(piece_model):
    m, rnd = piece_model, random.Random(2)
    texts = [*filter(None, ODD_TEXTS), *("".join(rnd.choice(" \n aehst's▁é1,日") for _ in range(rnd.randint(1, 90))) for _ in range(300))]
    for t in texts:
        ids = m.encode_stream(t)
        assert m.decode(ids) == t and np.frombuffer(m.encode(t), "<u4").tolist() == ids
        if pieces.SIGN not in t and all(k not in m.byte_of for k in ids):
            assert sum(m.pieces[m.text[k]][1] for k in ids) == best_sum(m, pieces.SIGN + t.replace(" ", pieces.SIGN))


def test_stream_commits_within_the_window(piece_model):
    m = piece_model
    runs = list(m.stream("▁then" * 5000 for _ in range(2)))
    assert len(runs) > 500 and max(map(len, runs)) < 6 * m.longest
    assert [k for r in runs for k in r] == m.encode_stream(" ".join(["then"] * 10000))


def test_op8_rows(spark, table_dir, piece_model):
    out = {r["doc_id"]: r for r in pieces.op8_sentencepiece(spark, table_dir(ODD_TEXTS)).collect()}
    assert all(r["same"] for r in out.values())
    for i, t in enumerate(ODD_TEXTS):
        assert out[i]["n_ids"] == len(piece_model.encode_stream(t) if t else []) and out[i]["ids_crc32"] == zlib.crc32(piece_model.encode(t))
