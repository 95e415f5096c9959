"""Packing under a loss limit that binds."""

import random
from collections import defaultdict

from test_token_operators import WORD, plain

from forktide.llm import packing
from forktide.llm.tokens import public_path


def test_a_loss_limit_binds_on_pieces_with_spans(spark):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice(["then", "a", "house", "river"]) for _ in range(rnd.randint(1, 400))) for _ in range(300)]
    sizes = [len(x) + 1 for x in plain(WORD, texts)]
    spans = [None if i % 10 == 0 else [] if i % 10 == 1 else [(a := rnd.randrange(n), rnd.randint(a, n)) for _ in range(3)] for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(list(zip(range(300), texts, spans)), "doc_id long, text string, spans array<struct<start:int,end:int>>").coalesce(2)
    out = packing.pack_documents(docs, public_path(WORD), length=256, segments=16, loss=60, loss_spans="spans").collect()
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        s, at, size = spans[r["doc_id"]], r["start"], r["length"]
        bears = [s is None or any(a <= k < b for a, b in s) for k in range(at + 1, at + size)]
        assert r["loss_tokens"] == sum(bears)
        covered[r["doc_id"]] += range(at, at + size)
        sequences[r["sequence_id"]].append(r)
    assert all(sorted(covered[i]) == list(range(n)) for i, n in enumerate(sizes))
    tokens = [sum(r["length"] for r in s) for s in sequences.values()]
    losses = [sum(r["loss_tokens"] for r in s) for s in sequences.values()]
    assert max(tokens) <= 256 and max(map(len, sequences.values())) <= 16 and max(losses) <= 60
    assert sum(x == 60 and n < 256 for n, x in zip(tokens, losses)) > 10
