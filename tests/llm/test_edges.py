"""Every operator and stage on nulls, repeated rows, clashing names, empty tables and a text of some megabytes."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm_operators import plain_components, plain_counts, plain_removal, plain_sets
from test_resampling import plain_draw
from test_token_operators import BYTE, WORD, crc, plain

import corpus_pipeline
from forktide.llm import near_dedup, registry

DOCUMENT_QUERIES = [n for n in registry.QUERIES if n != "op7_chat_format"]
#: Names that the operators use inside.
CLASHES = "score lang_pred _text _kept kept_id row doubtful text_id hits cut spans pattern quality kept n_words vote_bars rep digest sketch minimiser hash bound turn _in_0 _in_1 _place _bits _block number first"


def long_text(rnd, words):
    return " ".join(rnd.choice(["the", "of", "wort", "mot", "palabra", "x1", "é"]) + str(rnd.randint(0, 10**6)) for _ in range(words))


def edge_rows():
    rnd = random.Random(21)
    plain_text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, plain_text), (None, plain_text), (None, None), (None, ""), (1, plain_text), (1, plain_text), (2, "other words of a text"), (2, "and a second text of that id"), (3, None), (4, ""), (5, " \n\t ")]
    return [*rows, (6, long_text(rnd, 400_000)), (7, "x" * 2_000_000)]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges"))
    rows = [(d, t, None if i % 3 else "en", "s", None, *["clash"] * len(CLASHES.split())) for i, (d, t) in enumerate(edge_rows())]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in CLASHES.split())
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "wort the palabra"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_every_row_is_answered(spark, edge_dir, name):
    out = registry.QUERIES[name](spark, edge_dir).collect()
    ids = Counter(d for d, _ in edge_rows())
    if name == "op2_sharding":
        assert len(out) == len(edge_rows())
    elif name == "op4_packing":
        starts = [r["doc_id"] for r in out if r["start"] == 0]
        assert Counter(starts) == ids
        by = Counter()
        for r in out:
            by[r["doc_id"]] += r["length"]
        assert by[6] == len(plain(WORD, [dict(edge_rows())[6]])[0]) + 1
    else:
        assert Counter(r["doc_id"] for r in out) == ids
    if name == "op10_quality_rules":
        want = Counter((d, *plain_counts(t)) for d, t in edge_rows())
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out) == want
    if name == "op5_substring_dedup":
        want = plain_removal(dict(enumerate(t for _, t in edge_rows())))
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in out) == Counter((d, *want[i][:2]) for i, (d, _) in enumerate(edge_rows()))
    if name == "op6_chunk_store":
        ids = plain(BYTE, [t for _, t in edge_rows()])
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == Counter((d, len(x) + 1, crc(x + [0])) for (d, _), x in zip(edge_rows(), ids))
        at = 0
        for r in sorted(out, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["n_tokens"]
        named = [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])]
        assert named == sorted(named, key=lambda d: -1 if d is None else d)
    if name == "op8_sentencepiece":
        assert all(r["same"] for r in out)
    if name == "op9_language_id":
        assert all((r["lang_pred"] == "und") == (t is None or not any(c.isalpha() for c in t)) for r in out for d, t in edge_rows() if d == r["doc_id"] and d in (3, 4, 5, 6, 7))
        assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    if name == "op11_importance_resampling":
        want, drawn = plain_draw(edge_rows(), ["wort the palabra", None])
        assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in out) == want and sorted(r["rank"] for r in out if r["rank"]) == [r[4] for r in drawn]
    if name == "op12_suffix_dedup":
        by = {r["doc_id"]: r for r in out}
        assert (by[7]["n_removed"], by[7]["n_spans"]) == (1_999_999, 1) and by[6]["n_removed"] == 0 and by[1]["n_removed"] == by[1]["n_bytes"]
        kept = [r["n_removed"] for r in out if r["doc_id"] is None and r["n_bytes"] > 100]
        assert sorted(kept) == [0, len(edge_rows()[0][1])]
    if name == "op13_fill_in_middle":
        plain_ = {hashlib.sha256((t or "").encode()).hexdigest() for _, t in edge_rows()}
        assert {r["restored_sha256"] for r in out} == plain_ and all(r["form"] == "plain" for r in out if r["n"] == 0)
    if name == "op1_near_dedup":
        assert all(r["component_id"] == r["doc_id"] and r["kept"] == (r["doc_id"] is not None) for r in out)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_every_column(spark, edge_dir, name, stage):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = stage(spark, docs, edge_dir)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == "clash" for r in rows for c in CLASHES.split())
    ids = Counter(r["doc_id"] for r in rows)
    if name == "MinHash near-dedup":
        assert ids == Counter({None: 4, 1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1})
    if name == "substring dedup":
        assert ids == Counter(d for d, _ in edge_rows())
    assert stage(spark, docs.limit(0), edge_dir).count() == 0


def test_many_equal_rows_grow_in_proportion(spark, table_dir):
    """Copies of one row neither multiply nor part, whatever their number."""
    text = " ".join(f"w{i}" for i in range(120))
    for n in (50, 200):
        path = table_dir([(5, text)] * n + [(6, text)] * n + [(9, "alone " * 40)])
        out = registry.QUERIES["op5_substring_dedup"](spark, path).collect()
        assert len(out) == 2 * n + 1 and all(r["n_removed"] == (120 if r["doc_id"] < 9 else 40) for r in out)
        rows = registry.QUERIES["op1_near_dedup"](spark, path).collect()
        assert Counter((r["doc_id"], r["component_id"]) for r in rows) == {(5, 5): n, (6, 5): n, (9, 9): 1}


def test_near_dedup_of_doubtful_ids(spark, table_dir):
    """Rows of one id with different texts are left alone, all others are compared as ever."""
    base = " ".join(f"w{i}" for i in range(80))
    rows = [(1, base), (2, base + " more"), (3, base), (3, "something else"), (4, None), (4, "five words are not many"), (8, base.upper())]
    path = table_dir(rows)
    out = Counter((r["doc_id"], r["component_id"]) for r in near_dedup.op1_near_dedup(spark, path).collect())
    want = plain_components(plain_sets({d: t for d, t in rows if d not in (3, 4)}))
    assert out == Counter([*want.items(), (3, 3), (3, 3), (4, 4), (4, 4)])
    stage = near_dedup.near_dedup_stage(spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in stage) == sorted([(1, base), (3, base), (3, "something else"), (4, ""), (4, "five words are not many")])


def test_chat_on_nulls_and_a_long_text(spark, table_dir):
    schema = "conv_id long, turn long, role string, text string, start long, formatted string, kind int"
    long = "[x] \\ <" * 300_000
    rows = [(None, 0, "user", None), (None, 1, "assistant", long), (1, None, None, "a"), (1, 0, "assistant", "b"), (1, 0, "assistant", "b")]
    out = {r["conv_id"]: r for r in registry.QUERIES["op7_chat_format"](spark, table_dir([(*r, 1, "clash", 2) for r in rows], "conversations", schema)).collect()}
    assert set(out) == {None, 1, -7} and out[None]["loss_chars"] == len(long) and (out[1]["n_turns"], out[1]["loss_chars"], out[1]["n_examples"]) == (3, 2, 2)


def test_arrays_are_not_shared_between_batches():
    from forktide.llm.substrings import super_kmers

    words = [f"w{i % 50}".encode() for i in range(300)]
    text, minimiser, start, n = super_kmers([words, words[:10], words])
    half = len(text) // 2
    assert text.tolist() == [0] * half + [2] * half and np.array_equal(minimiser[:half], minimiser[half:]) and np.array_equal(start[:half], start[half:]) and n.sum() == 2 * (300 - 34)
