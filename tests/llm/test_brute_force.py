"""Language ID, quality rules, the piece model and packing's choices against their definitions, worked out one by one."""

import math
import random
from collections import Counter

import numpy as np
from odd_texts import ODD_TEXTS

from forktide.llm import language_id, packing, pieces, quality
from forktide.llm.tokens import public_path

# Language ID: plain sets, the whole kernel, explicit features and solution.


def plain_grams(text):
    chars = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not chars.strip():
        return set()
    chars = f" {' '.join(chars.split())} "
    out = set()
    for n in language_id.ORDERS:
        for i in range(len(chars) - n + 1):
            h = 0
            for k in range(n):
                h = (h + ord(chars[i + k]) + k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
                h ^= h >> 29
            out.add(h >> (64 - language_id.BITS))
    return out


def kernel(a, b):
    return len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0.0


def test_spectrum_is_the_plain_set():
    for t in [*ODD_TEXTS, "Über den Wolken, 3x!", "a1b2  c", "ÀÉ\nñ"]:
        assert language_id.spectrum(t).tolist() == sorted(plain_grams(t))


def test_scores_are_those_of_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang IS NOT NULL AND length(text) < 1500").orderBy("doc_id").limit(120).collect()
    turns, rows = Counter(), []
    for d in docs[:80]:
        turns[d["lang"]] += 1
        rows.append((turns[d["lang"]], d["lang"], d["doc_id"], d["text"]))
    model = language_id.train(spark.createDataFrame(rows, "turn int, lang string, doc_id long, text string"), landmarks=15, ridge=0.05)
    labels, scores = model.score([d["text"] for d in docs])

    rows.sort(key=lambda r: r[:3])
    sets = [plain_grams(r[3]) for r in rows]
    marks = sets[:15]
    between = np.array([[kernel(a, b) for b in marks] for a in marks])
    near = np.array([[kernel(a, b) for b in marks] for a in sets])
    names = sorted({r[1] for r in rows})
    values, vectors = np.linalg.eigh(between)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] @ np.diag(values[good] ** -0.5)
    f = near @ root
    share = Counter(r[1] for r in rows)
    weight = np.diag([len(rows) / len(names) / share[r[1]] for r in rows])
    target = np.array([[1.0 if r[1] == x else -1.0 for x in names] for r in rows])
    solved = np.linalg.inv(f.T @ weight @ f + 0.05 * len(rows) / 15 * np.eye(f.shape[1])) @ f.T @ weight @ target
    for d, label, score in zip(docs, labels, scores):
        value = np.array([kernel(plain_grams(d["text"]), m) for m in marks]) @ root @ solved
        assert abs(score - np.clip((1 + value.max()) / 2, 0, 1)) < 1e-3
        assert label == names[int(value.argmax())] or np.sort(value)[-1] - np.sort(value)[-2] < 1e-3


# Quality: expectation-maximisation document by document.


def vote(row, rule):
    top, bottom, good, bad = quality.RULES[rule]
    if row[bottom] == 0:
        return 0
    share = row[top] / row[bottom]
    return -1 if share >= bad else 1 if share < good else 0


def plain_posteriors(votes):
    p = [0.2 if -1 in v else 0.9 for v in votes]
    for _ in range(quality.ROUNDS):
        prior = (sum(p) + 1) / (len(p) + 2)
        tables = []
        for r in range(len(votes[0])):
            good, bad = Counter({k: 0.5 for k in (-1, 0, 1)}), Counter({k: 0.5 for k in (-1, 0, 1)})
            for v, q in zip(votes, p):
                good[v[r]] += q
                bad[v[r]] += 1 - q
            odds = {k: math.log(good[k] / sum(good.values())) - math.log(bad[k] / sum(bad.values())) for k in (-1, 0, 1)}
            tables.append({-1: min(odds[-1], 0), 0: 0.0, 1: max(odds[1], 0)})
        new = []
        for v in votes:
            logit = math.log(prior / (1 - prior)) + sum(t[x] for t, x in zip(tables, v))
            new.append(1 / (1 + math.exp(-max(-50, min(50, logit)))))
        done, p = max(abs(a - b) for a, b in zip(p, new)) < 1e-9, new
        if done:
            break
    return p


def test_verdicts_are_those_of_single_documents(spark, sf_dir):
    rows = quality.counted(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"]).collect()
    votes = [[vote(r, name) for name in quality.RULES] for r in rows]
    assert all([r[f"vote_{name}"] for name in quality.RULES] == v for r, v in zip(rows, votes))
    want = dict(zip((r["doc_id"] for r in rows), plain_posteriors(votes)))
    for r in quality.op10_quality_rules(spark, sf_dir).collect():
        p = want[r["doc_id"]]
        assert abs(r["quality"] - p) < 1e-6 and (abs(p - quality.KEEP_FROM) < 1e-6 or r["kept"] == (not r["base_failed"] and p >= quality.KEEP_FROM))


# The piece model: all cuts by dynamic programming over the whole text, byte pieces included.


def plain_pieces(m, text):
    if not text:
        return []
    signed = pieces.SIGN + text.replace(pieces.SIGN, "\ud800").replace(" ", pieces.SIGN)
    best, back = [0.0], [None]
    for end in range(1, len(signed) + 1):
        score, way = -math.inf, None
        for start in range(max(0, end - m.longest), end):
            piece = signed[start:end]
            add = m.pieces[piece][1] if piece in m.pieces else m.unknown if end == start + 1 else None
            if add is not None and best[start] + add > score:
                score, way = best[start] + add, start
        best.append(score)
        back.append(way)
    out, end = [], len(signed)
    while end:
        piece = signed[back[end] : end]
        raw = (pieces.SIGN if piece == "\ud800" else piece).encode("utf-8", "surrogatepass")
        out.append([m.pieces[piece][0]] if piece in m.pieces else [m.bytes[b] for b in raw])
        end = back[end]
    return [k for part in reversed(out) for k in part]


def test_ids_are_those_of_the_plain_search():
    m, rnd = pieces.PieceModel(public_path("piece_bpe_32k.model")), random.Random(9)
    texts = [*ODD_TEXTS, "ein Wort " * 30, *("".join(rnd.choice("   \naehst's▁é1,日nori") for _ in range(rnd.randint(1, 150))) for _ in range(200))]
    texts += ["".join(rnd.choice("aehstnori日") for _ in range(n)) for n in (17, 40, 65, 300) for _ in range(20)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in m.encode_all(texts)]
    assert ids == [plain_pieces(m, t) for t in texts]
    assert ids == [m.encode_stream(t or "") for t in texts]


# Packing: the piece with the largest dot product goes in next.


def plain_choice(items, limits):
    """Sequences of (tokens, 1, loss) items under the limits, all waiting from the start."""
    left, out = dict(enumerate(items)), []
    while left:
        room, sequence = [1.0] * 3, []
        while True:
            total = [sum(x[k] for x in left.values()) / limits[k] for k in range(3)]
            fits = [i for i, x in left.items() if all(x[k] / limits[k] <= room[k] for k in range(3))]
            if not fits:
                break
            best = max(fits, key=lambda i: (sum(left[i][k] / limits[k] * room[k] * total[k] for k in range(3)), -i))
            x = left.pop(best)
            sequence.append(best)
            room = [r - x[k] / limits[k] for k, r in enumerate(room)]
        out.append(sequence)
    return out


def test_packing_takes_the_largest_dot_product():
    rnd = random.Random(12)
    items = [(n := rnd.randint(1, 900), 1, rnd.randint(0, min(n, 256))) for _ in range(220)]
    p = packing.Packer(1024, 8, 256, cut=False, waiting=1000)
    out = [s for i, (n, _, loss) in enumerate(items) for s in p.add(i, n, loss)] + list(p.finish())
    assert [[q.item for q in s] for s in out] == plain_choice(items, (1024, 8, 256))


def test_packing_conversations_under_three_limits(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    docs = packing.conversation_documents(turns, public_path("word_bpe_49k.json"))
    rows = packing.pack_documents(docs, public_path("word_bpe_49k.json"), length=1024, segments=16, loss=384, loss_spans="spans").collect()
    sequences = {}
    for r in rows:
        n = sequences.setdefault(r["sequence_id"], [0, 0, 0])
        n[0], n[1], n[2] = n[0] + r["length"], n[1] + 1, n[2] + r["loss_tokens"]
    assert all(n[0] <= 1024 and n[1] <= 16 and n[2] <= 384 for n in sequences.values())
    assert sum(n[2] >= 380 for n in sequences.values()) > 0.2 * len(sequences)  # the loss limit binds
    assert sum(n[0] for n in sequences.values()) == sum({r["doc_id"]: r["doc_tokens"] for r in rows}.values())
    need = max(sum(n[0] for n in sequences.values()) / 1024, sum(n[2] for n in sequences.values()) / 384)
    assert len(sequences) <= 1.1 * need + spark.sparkContext.defaultParallelism * 10  # and a tail for each partition
