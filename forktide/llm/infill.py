r"""Fill-in-the-middle transformation with the Split pre-tokenizer of the tokenizers library.

Split with a pattern and the behaviour ``isolated`` needs no vocabulary and no training: it gives every match, left to right, with its
code-point offsets.  The number of offsets is n; the offset at a rank is where that many units end, so two ranks cut a text in
prefix, middle and suffix.

A unit is one code point here.  No match of that pattern looks beyond itself, so a text may be cut anywhere: Split gets it in blocks of BLOCK
code points, and a worker remembers how many offsets a block has, as few blocks of that size differ; the offsets themselves are asked
for where a cut lies.  Other patterns see the whole text at once.

Each document's cuts and form follow from the hash of its id alone, so a document gets the same example whatever stands around it,
wherever it is computed.

Defined cases: a null text is empty; an empty text, or one with a sentinel in it, is plain, so every output can be taken apart again; a
null doc_id is hashed as an empty text; repeated rows give the same example; texts of any length are cut whole; an empty table gives
an empty result; further columns, whatever their names, are ignored by the query and may be kept by the operator.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, map_arrow

#: The dot that takes line ends too.
CODE_POINT = "(?m:.)"
#: Code points that Split gets at once.
BLOCK = 4
CACHE_BLOCKS = 300_000
SEED = 1
#: Of 100 documents, those that become an example, and of these the ones whose suffix comes first.
RATE, SPM_RATE = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Units(dict):
    """The units of texts by their code-point offsets; the dictionary remembers how many a block has."""

    def __init__(self, pattern: str = CODE_POINT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        from tokenizers import Regex, pre_tokenizers

        self._split = pre_tokenizers.Split(Regex(pattern), "isolated")
        self._cut = re.compile(f".{{1,{BLOCK}}}", re.DOTALL) if pattern == CODE_POINT else None

    def ends(self, text: str) -> list[int]:
        """The offset at which each unit ends."""
        return [end for _, (_, end) in self._split.pre_tokenize_str(text)]

    def __missing__(self, block: str) -> int:
        n = len(self.ends(block))
        if self._cut:
            if len(self) >= CACHE_BLOCKS:
                self.clear()
            self[block] = n
        return n

    def ranked(self, text: str) -> Ranked:
        return Ranked(self, self._cut.findall(text) if self._cut else [text] * bool(text))


class Ranked:
    """A text's offsets: how many they are, and the one at a rank."""

    def __init__(self, units: Units, blocks: list[str]):
        self.units, self.blocks = units, blocks
        self.upto = np.cumsum(np.fromiter(map(units.__getitem__, blocks), np.int64, len(blocks)))
        self.n = int(self.upto[-1]) if blocks else 0

    def offset(self, rank: int) -> int:
        """The code points of the first ``rank`` units."""
        if not rank:
            return 0
        at = int(np.searchsorted(self.upto, rank))
        before = int(self.upto[at - 1]) if at else 0
        return BLOCK * at + self.units.ends(self.blocks[at])[rank - before - 1]  # all blocks before have BLOCK code points


_units: dict[str, Units] = {}


def units(pattern: str) -> Units:
    if pattern not in _units:
        _units[pattern] = Units(pattern)
    return _units[pattern]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from a document's id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def example(text: str, units: Units, h: list[int], rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, str, int | None, int | None]:
    """(n, form, output, prefix_chars, middle_chars) of one text."""
    ranked = units.ranked(text)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return ranked.n, "plain", text, None, None
    a, b = (ranked.offset(r) for r in sorted((h[0] % (ranked.n + 1), h[1] % (ranked.n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_rate:
        return ranked.n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return ranked.n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def fill_in_middle(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), pattern: str = CODE_POINT, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The kept columns with n, form, prefix_chars, middle_chars and output; docs has doc_id and text.  No kept column may have one of these names."""
    kept = list(keep)

    def f(r):
        n, form, output, prefix, middle = zip(*(example(t or "", units(pattern), draws(seed, d), rate, spm_rate) for t, d in zip(r["_text"], r["_id"])))
        return {c: r[c] for c in kept} | {"n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": output}

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    read = docs.select(*(F.col(f"`{c}`") for c in kept), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    return map_arrow(read, f, f"{fields}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone: no text that is cut has a sentinel, so the first of each kind is its own."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    piece = (lambda i: F.get(part, F.lit(i)))
    return F.when(form == "plain", output).when(form == "psm", F.concat(piece(1), piece(3), piece(2))).otherwise(F.concat(piece(2), piece(3), piece(1)))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    made = fill_in_middle(documents(spark, sf_dir))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE_SQL = f"""
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || substr(t, 1, a) || '{SUFFIX}' || substr(t, b + 1) || '{MIDDLE}' || substr(t, a + 1, b - a)
    ELSE '{SUFFIX}' || substr(t, b + 1) || '{PREFIX}' || substr(t, 1, a) || '{MIDDLE}' || substr(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""
