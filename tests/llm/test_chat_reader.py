"""The reader of formatted conversations finds turns without a pattern over whole texts."""

import random
import tracemalloc

import pytest

from forktide.llm import chat


def test_turns_come_back_whatever_is_in_them():
    rnd = random.Random(1)
    for _ in range(1500):
        t = "".join(rnd.choice("\\[]<>/a s\nINT") for _ in range(rnd.randint(0, 30)))
        turns = [("user", t), ("assistant", t), ("tool<[\\", t), ("system", t), ("assistant", "</s>" + t + "\\"), ("", t)]
        formatted = "".join(chat.segment(*x)[0] for x in turns)
        found = list(chat.parse(formatted))
        assert [(r, x) for r, x, *_ in found] == turns and all(chat.unescape(formatted[a:b]) == x for _, x, a, b in found)


def test_a_turn_without_an_end_is_an_error():
    for bad in ("[INST] a", "a\\</s>", "[ROLE] a [TEXT] b"):
        with pytest.raises(ValueError, match="no end"):
            list(chat.parse(bad))


def test_memory_of_a_long_turn():
    formatted = chat.segment("assistant", "if (a[i] < b) { x = \\n; } " * 400_000)[0]
    tracemalloc.start()
    role, text, *_ = next(chat.parse(formatted))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert role == "assistant" and len(text) == 10_400_000 and most < 10 * len(text)
