"""Quality rules under weak supervision.

Each rule looks at a document's counts and votes good, bad or abstains.  Expectation-maximisation over the counts of vote
patterns estimates how often each rule votes either way on good and on bad documents, without labels; the posterior
probability of a good document, not a demand that all rules pass, is the verdict.  There are at most 3 ** rules patterns,
so their counts, and the table of posteriors that is joined back, have a fixed bound.

Defined cases: a null or empty text has no words and all counts 0, and fails the base check; equal texts, those of repeated rows
too, get equal verdicts; a posterior of exactly KEEP_FROM is kept; a null doc_id is carried; an empty table gives an empty result;
columns of the input other than doc_id and text, whatever their names, have no influence and stay in the stage.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, gram_hashes, map_arrow, word_hashes, words_of, written

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
KEEP_FROM = 0.5
ROUNDS = 200
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_bars", "n_symbol_ends")

#: Rule: (numerator, denominator, good below, bad from); between the two it abstains.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.05, 0.30),
    "symbol_share": ("n_symbols", "word_chars", 0.01, 0.06),
    "symbol_ends": ("n_symbol_ends", "n_words", 0.03, 0.20),
    "repeats": ("n_repeat_words", "n_words", 0.05, 0.20),
    "lines": ("n_dup_lines", "n_lines", 0.15, 0.50),
    "capitals": ("n_upper", "n_letters", 0.15, 0.40),
    "shouts": ("n_shouts", "n_words", 0.05, 0.20),
    "bars": ("n_bars", "n_words", 0.05, 0.20),
    "long_words": ("word_chars", "n_words", 9.0, 14.0),
}
SYMBOL_END = re.compile(rb"[#*$%&|<>](?=[\x20\x09-\x0d]|\Z)")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def base_counts(text: str | None) -> dict[str, int]:
    words = words_of(text)
    if not words:
        return dict.fromkeys(COUNTS, 0)
    raw = text.encode("utf-8", "surrogatepass")
    lines, seen, again = 0, set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            lines += 1
            again += line in seen
            seen.add(line)
    grams = gram_hashes(word_hashes(words), WINDOW)
    repeated = 0
    if len(grams):
        _, back, count = np.unique(grams, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(count[back] > 1)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + WINDOW, -1)
        repeated = int(np.count_nonzero(np.cumsum(edge)[:-1]))
    return {
        "n_words": len(words), "word_chars": len(text) - sum(raw.count(c) for c in SPACES), "n_symbols": sum(raw.count(c) for c in SYMBOLS),
        "n_dup_lines": again, "n_repeat_words": repeated, "n_lines": lines, "n_upper": len(UPPER.findall(text)),
        "n_letters": len(raw) - len(raw.translate(None, _ASCII_LETTERS)) + sum(len(x) for x in _WIDE.findall(text)),
        "n_shouts": raw.count(b"!"), "n_bars": words.count(b"|"), "n_symbol_ends": len(SYMBOL_END.findall(raw)),
    }


_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_WIDE = re.compile(r"[^\x00-\x7f]+")


def votes(df: DataFrame) -> DataFrame:
    """df with vote_<rule>: 1 good, -1 bad, 0 abstained; and pattern, all of them as a number."""
    for name, (top, bottom, good, bad) in RULES.items():
        share = F.col(top) / F.greatest(F.col(bottom), F.lit(1))
        vote = F.when(F.col(bottom) == 0, 0).when(share >= bad, -1).when(share < good, 1).otherwise(0)
        df = df.withColumn(f"vote_{name}", vote.cast("int"))
    pattern = F.lit(0)
    for name in RULES:
        pattern = pattern * 3 + F.col(f"vote_{name}") + 1
    return df.withColumn("pattern", pattern)


def unpack(pattern: np.ndarray, rules: int) -> np.ndarray:
    out = np.empty((len(pattern), rules), np.int64)
    for i in reversed(range(rules)):
        pattern, out[:, i] = pattern // 3, pattern % 3
    return out


def posterior(pattern: np.ndarray, count: np.ndarray, rules: int, rounds: int = ROUNDS) -> np.ndarray:
    """Probability of a good document for each pattern.  Starts from the votes' mean; counts of one half smooth.

    A rule may be useless but not inverted: its bad votes are held to be at least as likely on bad documents.
    """
    v = unpack(np.asarray(pattern), rules)
    count = np.asarray(count, float)
    signs = v - 1
    bad = (signs < 0).sum(1)
    p = np.where(bad > 0, 0.2, 0.9)
    for _ in range(rounds):
        prior = (float((p * count).sum()) + 1) / (float(count.sum()) + 2)
        logit = np.full(len(v), np.log(prior / (1 - prior)))
        for r in range(rules):
            good = np.bincount(v[:, r], weights=p * count, minlength=3) + 0.5
            poor = np.bincount(v[:, r], weights=(1 - p) * count, minlength=3) + 0.5
            weight = np.log(good / good.sum()) - np.log(poor / poor.sum())
            weight[0], weight[2] = min(weight[0], 0.0), max(weight[2], 0.0)
            weight[1] = 0.0  # an abstention tells nothing
            logit += weight[v[:, r]]
        new = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        done, p = np.abs(new - p).max(initial=0) < 1e-9, new
        if done:
            break
    return p


def counted(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, the counts and the votes."""
    kept = list(keep)

    def f(r):
        counts = [base_counts(t) for t in r["_text"]]
        return {n: r[n] for n in kept} | {c: [x[c] for x in counts] for c in COUNTS}

    fields = ", ".join([*(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in kept), *(f"{c} long" for c in COUNTS)])
    return votes(map_arrow(docs.select(*(F.col(f"`{n}`") for n in kept), F.col("text").alias("_text")), f, fields))


def judged(rows: DataFrame, all_rows: DataFrame) -> DataFrame:
    """rows with base_failed, quality (posterior) and kept; the votes of all_rows are what is learned from."""
    spark = rows.sparkSession
    found = all_rows.groupBy("pattern").count().collect()  # 3 ** rules rows at most
    pattern, count = np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], float)
    table = spark.createDataFrame([(int(k), float(p)) for k, p in zip(pattern, posterior(pattern, count, len(RULES)))], "pattern int, quality double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = rows.join(F.broadcast(table), "pattern", "left").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rows = written(counted(documents(spark, sf_dir), ["doc_id"]))
    return judged(rows, rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with kept = false go; the others stay as they are."""
    bounded_batches(spark)
    renamed = docs.toDF(*(f"_in_{i}" for i in range(len(docs.columns)))).withColumn("text", F.col(f"_in_{docs.columns.index('text')}"))
    carried = [c for c in renamed.columns if c != "text"]
    rows = written(counted(renamed, carried), compression="zstd")
    return judged(rows, rows).where("kept").select(*carried).toDF(*docs.columns)
