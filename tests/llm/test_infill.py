"""Fill-in-the-middle against a plain version, and its offsets."""

import hashlib
import random
from collections import Counter

import pytest
from odd_texts import ODD_TEXTS

from forktide.llm import infill


def plain_example(doc_id, text):
    t, n = text or "", len(text or "")
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    return (n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_a_plain_version(spark, table_dir):
    rnd = random.Random(8)
    odd = [*ODD_TEXTS, "has <P> inside", "<M>", "ends in <", "<S", "\U0001f600" * 1500, "a\r\n\x00b", "é" * 7, *("".join(rnd.choice("ab<PSM>é \U0001f600\n") for _ in range(40)) for _ in range(200))]
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "null id"), (None, None), (7, "again"), (7, "again"), (10**12, "x y " * 500_000)]
    want = Counter((d, *plain_example(d, t)[:4], digest(plain_example(d, t)[4]), digest(t or "")) for d, t in rows)
    assert Counter(map(tuple, infill.op13_fill_in_middle(spark, table_dir(rows)).collect())) == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}


def test_clashing_names_and_an_empty_table(spark, table_dir):
    schema = "doc_id long, text string, n string, form string, output string, _text string"
    for rows in ([], [(3, "some text", *"abcd")]):
        assert infill.op13_fill_in_middle(spark, table_dir(rows, schema=schema)).count() == len(rows)


@pytest.mark.parametrize("text", ["", "abc", "abcdefghi", "\U0001f600é" * 9])
def test_offsets_of_code_points(text):
    ranked = infill.Units().ranked(text)
    assert ranked.n == len(text) and [ranked.offset(k) for k in range(ranked.n + 1)] == list(range(len(text) + 1))


def test_other_units_see_the_whole_text(spark):
    words = infill.Units(r"\w+ ?").ranked("one two  three")
    assert [words.offset(k) for k in range(words.n + 1)] == [0, 4, 8, 9, 14]
    docs = spark.createDataFrame([(i, "one two  three") for i in range(40)], "doc_id long, text string")
    out = infill.fill_in_middle(docs, pattern=r"\w+ ?").withColumn("back", infill.restored(infill.F.col("output"), infill.F.col("form"))).collect()
    assert all(r["n"] == 4 and r["back"] == "one two  three" and r["prefix_chars"] in (None, 0, 4, 8, 9, 14) for r in out)
