"""Sharding, media, language ID, quality, chat, near-dedup, substring dedup and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from odd_texts import ODD_TEXTS

import corpus_pipeline
from forktide.llm import chat, language_id, near_dedup, ogg, quality, registry, sharding, substrings

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def texts_of(spark, path):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = c.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(found.fetchall())


# Sharding.


def test_table_is_even_and_stable():
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 1009)
    count = Counter(table)
    assert max(count.values()) - min(count.values()) <= 1
    smaller = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, smaller) if a != 6)
    assert moved < 0.2 * 1009
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 11)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 12)


def test_sharding_of_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([(None, 1, "x"), (5, 2, "y"), (5, 3, "z")], "k long, slot int, shard string")
    out = sharding.shard_rows(df, "k").collect()
    assert len(out) == 3 and all(r["shard"] in sharding.SHARDS for r in out) and len({r["shard"] for r in out if r["k"] == 5}) == 1
    assert sharding.shard_rows(df.limit(0), "k").count() == 0


# Media.


def plain_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


def test_page_crc():
    rnd = random.Random(1)
    for n in (0, 1, 27, 300):
        data = rnd.randbytes(n)
        assert ogg.page_crc(data) == plain_crc(data)


@pytest.mark.parametrize("n", [64, 255 * 64, 4096, 8192, 12345 * 64, 255 * 16])
@pytest.mark.parametrize("segments", [1, 7, 64, 255])
def test_ogg_round_trip(n, segments):
    payload = random.Random(n).randbytes(n)
    media = ogg.read_ogg(ogg.write_ogg(payload, segments=segments))
    assert media.payload == payload and media.streams == 2
    assert [t[0] for t in media.times] == list(range(0, n, ogg.BLOCK)) and media.times[-1][1] == n


def test_damaged_ogg_is_noticed():
    data = ogg.write_ogg(random.Random(0).randbytes(20000))
    for at in (0, 5, 30, 5000, len(data) - 1):
        with pytest.raises(ogg.OggError):
            ogg.read_ogg(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ogg.OggError):
        ogg.read_ogg(data[:-10])


def test_op3_rows(spark, table_dir):
    out = {r["doc_id"]: r for r in ogg.op3_media_ogg(spark, table_dir(ODD_TEXTS)).collect()}
    for i, t in enumerate(ODD_TEXTS):
        raw = (t or "").encode()
        padded = raw + bytes(-len(raw) % 64 or 64 * (not raw))
        r = out[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        stored = ogg.write_ogg(padded)
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert ogg.op3_media_ogg(spark, table_dir([])).count() == 0


# Language ID.


def test_language_accuracy_and_odd_texts(spark, table_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    out = language_id.op9_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97 and all(0 <= r["score"] <= 1 for r in out)
    odd = {r["doc_id"]: r for r in language_id.op9_language_id(spark, table_dir([*ODD_TEXTS, (99, "the text", None, None, None)])).collect()}
    for i, t in enumerate(ODD_TEXTS):
        assert (odd[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
    assert language_id.op9_language_id(spark, table_dir([])).count() == 0
    unlabelled = language_id.op9_language_id(spark, table_dir([(1, "some words", None, None, None)])).collect()
    assert [r["lang_pred"] for r in unlabelled] == ["und"]


def test_spectrum_is_the_set_of_grams():
    a, b = language_id.spectrum("Abc, abc!"), language_id.spectrum("abc  ABC")
    assert np.array_equal(a, b) and len(language_id.spectrum("12 !?")) == 0


# Quality.


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i : i + 5])].append(i)
    again = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_quality_counts_and_verdicts(spark, table_dir, sf_dir):
    for path in (sf_dir, table_dir([*ODD_TEXTS, "a b c d e f a b c d e", "l one\nl one\nl two"])):
        texts = texts_of(spark, path)
        for r in quality.op10_quality_rules(spark, path).collect():
            want = plain_counts(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    assert quality.op10_quality_rules(spark, table_dir([])).count() == 0


def test_quality_leaves_good_documents(spark):
    verdict = quality.op10_quality_rules(spark, "/root/testdata/sf0.01").select("doc_id", "base_failed", "kept")
    out = verdict.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    assert np.mean([r["kept"] for r in out if r["quality"] == 1]) > 0.99 and np.mean([r["kept"] for r in out if r["quality"] == 0]) < 0.1


def test_posterior_finds_two_classes():
    rnd = random.Random(4)
    counts = Counter()
    for _ in range(4000):
        bad = rnd.random() < 0.2
        code = 0
        for p in ((0.9, 0.02), (0.8, 0.05), (0.7, 0.05), (0.5, 0.5)):
            code = code * 3 + (0 if rnd.random() < p[0 if bad else 1] else 2)
        counts[(code, bad)] += 1
    patterns = sorted({c for c, _ in counts})
    p = dict(zip(patterns, quality.posterior(np.array(patterns), np.array([counts[c, True] + counts[c, False] for c in patterns]), 4)))
    right = sum(n for (c, bad), n in counts.items() if (p[c] < 0.5) == bad)
    assert right > 0.97 * 4000


# Chat.


def test_chat_round_trip_and_examples(spark, table_dir, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    texts = ["</s>[INST] ok [/INST]", "", "\\[x] \\", " ends ", "[SYS] a [/SYS]", "<s> é\n"]
    rows = [(1, i, ("user", "assistant", "system", "tool [ROLE]")[i % 4], t) for i, t in enumerate(texts)] + [(2, 0, "assistant", "only"), (3, 0, "user", None), (4, None, None, "x"), (2, 0, "assistant", "only")]
    out = {r["conv_id"]: r for r in chat.op7_chat_format(spark, table_dir(rows, "conversations", schema)).collect()}
    assert set(out) == {1, 2, 3, 4, -7}
    for c in (1, 2, 3, 4):
        mine = [r for r in rows if r[0] == c]
        assert out[c]["n_turns"] == len(mine)
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
        replies = "".join(r[3] for r in mine if r[2] == "assistant")
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())
    path = str(tmp_path / "chat")
    chat.write_examples(spark.createDataFrame(rows, schema), path)
    full = sorted((r["conv_id"], r["position"], r["text"], r["reply_start"], r["reply_end"]) for r in chat.example_texts(spark, path).collect())
    examples = sorted(tuple(r) for r in spark.read.parquet(f"{path}/examples").collect())
    assert [(x[0], x[1], x[3], x[4]) for x in examples] == [(x[0], x[1], x[3], x[4]) for x in full] and [x[2] for x in examples][0] == len(chat.segment("user", texts[0])[0])
    assert [(c, chat.unescape(t[a:b])) for c, _, t, a, b in full] == [(1, ""), (1, texts[5]), (2, "only"), (2, "only")]
    assert [x[:2] for x in chat.parse(full[1][2])] == [(r[2], r[3]) for r in rows[:6]]
    assert chat.op7_chat_format(spark, table_dir([], "conversations", schema)).collect()[0]["conv_id"] == -7
    spark.createDataFrame([], spark.read.parquet(f"{path}/examples").schema).write.mode("overwrite").parquet(f"{path}/examples")
    assert all(r["loss_chars"] == 0 and r["n_examples"] == 0 for r in chat.read_back(spark, path).collect())  # the mask is the examples' alone


# Near-dedup.


def plain_sets(texts):
    out = {}
    for d, t in texts.items():
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(t or "")]
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def plain_components(sets):
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by = sorted(sets)
    for i, a in enumerate(by):
        for b in by[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def near_rows(rnd, n):
    """A crowd around one text, near the threshold, so that stars alone do not find all links."""
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(1, 9)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 60)}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def test_near_dedup_of_a_crowd(spark, table_dir, monkeypatch):
    rnd = random.Random(8)
    rows = near_rows(rnd, 160) + [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(500 + i, "Few Words") for i in range(3)] + [(600, "few words"), (700, "a b c d e f"), (701, "A B C D E F")]
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 16)
    path = table_dir(rows)
    want = plain_components(plain_sets(dict(rows)))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.op1_near_dedup(spark, path).collect()}
    assert got == want and len(set(want.values())) < len(rows) - 20
    assert near_dedup.op1_near_dedup(spark, table_dir([])).count() == 0


def test_least_shared_is_a_bound():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 90)
        a = {rnd.getrandbits(40) for _ in range(n)}
        b = set(rnd.sample(sorted(a), len(a) - rnd.randint(0, len(a) // 4)))
        b |= {rnd.getrandbits(40) for _ in range(rnd.randint(0, n // 4))}
        both = len(a & b)
        if 100 * both >= 75 * len(a | b):
            shared = len(set(sorted(a)[: near_dedup.SKETCH]) & set(sorted(b)[: near_dedup.SKETCH]))
            assert all(shared >= near_dedup.least_shared(np.array([len(s)]))[0] for s in (a, b))


def test_stage_keeps_one_of_each_group_and_unnamed_rows(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words"), (None, "a b c d e f g")]
    docs = spark.createDataFrame([(*r, "en", "s", 1, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, rep int")
    out = near_dedup.near_dedup_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 3]


# Substring dedup.


def plain_removal(texts):
    starts = defaultdict(list)
    words = {k: WORD.findall(t or "") for k, t in texts.items()}
    for d, w in words.items():
        for i in range(len(w) - 34):
            starts[tuple(w[i : i + 35])].append((d, i))
    gone = {(d, i + j) for at in starts.values() if len(at) > 1 for d, i in at for j in range(35)}
    return {d: (len(w), sum((d, i) in gone for i in range(len(w))), " ".join(x for i, x in enumerate(w) if (d, i) not in gone)) for d, w in words.items()}


@pytest.mark.parametrize("bucket", [substrings.BUCKET, 3, 1])
def test_substring_dedup(spark, table_dir, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET", bucket)
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    fill = lambda n: " ".join(f"f{rnd.randint(0, 10**6)}" for _ in range(n))
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100 + i, f"{fill(rnd.randint(0, 50))}\n{passage}  {fill(20)}") for i in range(12)] + [(200, "a " * 100), (201, fill(35)), (202, " ".join(f"q{i % 40}" for i in range(100)))]
    path = table_dir(rows)
    want = plain_removal(dict(rows))
    for r in substrings.op5_substring_dedup(spark, path).collect():
        n, removed, kept = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())
    out = substrings.substring_stage(spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()
    for r in out:
        assert " ".join(WORD.findall(r["text"] or "")) == want[r["doc_id"]][2]
        assert want[r["doc_id"]][1] or r["text"] == dict(rows)[r["doc_id"]]
    assert substrings.op5_substring_dedup(spark, table_dir([])).count() == 0


# The pipeline.


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(i)))
        last, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == names and 0 < docs.count() <= before, name
            before = docs.count()
    kept = {r["doc_id"]: r["text"] for r in last.collect()}
    deduplicated = spark.read.parquet(str(tmp_path / "2"))
    want = plain_removal({r["doc_id"]: r["text"] for r in deduplicated.collect()})
    assert all(" ".join(WORD.findall(kept[d] or "")) == k for d, (_, _, k) in want.items())
    sets = plain_sets({r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "1")).collect()})
    assert {r["doc_id"] for r in deduplicated.collect()} == set(plain_components(sets).values())
    assert {r["doc_id"] for r in docs.collect()} == set(kept)
    assert docs.count() == corpus_pipeline.run(spark, sf_dir).count()
