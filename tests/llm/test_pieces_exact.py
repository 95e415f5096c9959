"""One search: ids depend neither on what is encoded beside a text nor on where a stream commits."""

import random
from array import array

from forktide.llm import pieces
from forktide.llm.tokens import public_path


def fractional(seed):
    """The public model with other scores, many of which tie in sum."""
    m, rnd = pieces.PieceModel(public_path("piece_bpe_32k.model")), random.Random(seed)
    m.pieces = {p: (i, pieces.exact(-rnd.choice([0.1, 0.2, 0.3, 0.7, rnd.random() * 8]))) for p, (i, _) in m.pieces.items()}
    m.unknown = min(s for _, s in m.pieces.values()) - pieces.exact(pieces.PENALTY)
    m._table()
    return m


def plain_search(m, text):
    """The search from end to end, without a window or a commit."""
    n = len(text)
    best, back = [0] + [pieces.NONE] * n, [(0, -1)] * (n + 1)
    m.advance(text, best, back, 0, n)
    return m.path(text, back, n)


def test_ids_do_not_depend_on_the_batch():
    rnd = random.Random(5)
    for m in (fractional(1), fractional(2)):
        words = ["".join(rnd.choices("abcdefghij\u00e9\U0001f600", k=rnd.randint(1, 90))) for _ in range(150)]
        together, alone = m.encode_all(words), []
        for w in words:
            m.cache.clear()
            alone.append(m.encode_all([w])[0])
        assert together == alone
        for w, ids in zip(words, together):
            assert list(array("I", ids)) == m.encode_stream(w) == plain_search(m, m.signed(w))


def test_a_long_stretch_keeps_small_sums():
    m = fractional(3)
    text = "".join(random.Random(1).choices("abcde", k=20_000))
    assert list(array("I", m.encode(text))) == m.encode_stream(text) and m.decode_array(m.encode(text)) == text
