"""Quality rules by repetition coverage.

How much of a text lies inside n-grams of words, or whole lines, that the
text holds more than once. Every word gets a 64-bit hash, one prefix sum of a
polynomial then gives the hash of every n-gram of every length (a rolling
hash), and equal hashes inside a text mark their words as covered. All of it
is numpy over Arrow batches inside map tasks: no shuffle, and one text never
leaves its task.

Defined cases: a null text has no words; a text without words has zero
coverage; the order, ties and repeats of rows do not matter, because each row
is judged alone; input columns with the names of results are replaced, all
others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import SMALL_SLICE, small_batches, span_hashes, split_words, text_slices, word_hashes

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict. Shares are of the characters in words.

    The limits lie above the greatest share that a text labelled good reaches
    among those that pass the base rule (0.28 for 5-, 6- and 8-grams, 0.18 for
    10-grams, 0.14 for lines), and each can reject by itself.
    """
    ngrams: tuple[int, ...] = (5, 6, 8, 10)
    max_ngram_share: tuple[float, ...] = (0.32, 0.30, 0.28, 0.20)
    max_line_share: float = 0.18
    window: int = 8                  # words of the base rule's windows
    min_words: int = 20              # base rule
    max_window_percent: int = 30     # base rule


def repeated(hashes: np.ndarray) -> np.ndarray:
    """True where a value occurs at least twice in the array."""
    if len(hashes) < 2:
        return np.zeros(len(hashes), bool)
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice


def covered(words: np.ndarray, n: int) -> np.ndarray:
    """Words inside an n-gram that occurs at least twice (first included)."""
    if len(words) < n:
        return np.zeros(len(words), bool)
    at = np.arange(len(words) - n + 1)
    twice = repeated(span_hashes(words, at, at + n))
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:len(twice)] += twice
    edge[n:n + len(twice)] -= twice
    return np.cumsum(edge[:-1]) > 0


def line_facts(text: str) -> tuple[int, int, int]:
    """Lines with a word, lines equal to an earlier one, and the characters
    of the repeats' words."""
    seen: set[str] = set()
    lines = repeats = chars = 0
    for line in text.split("\n"):
        if not line.strip(" \t\n\x0b\x0c\r"):
            continue
        lines += 1
        if line in seen:
            repeats += 1
            chars += sum(map(len, line.replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")))
        else:
            seen.add(line)
    return lines, repeats, chars


def _facts(text: pa.Array, rules: RepetitionRules) -> dict[str, np.ndarray]:
    rows = len(text)
    offsets, words = split_words(text)
    hashes = word_hashes(words)
    size = np.asarray(pc.utf8_length(words).to_numpy(zero_copy_only=False), np.int64)
    total = np.concatenate(([0], np.cumsum(size)))
    out = {"n_words": np.diff(offsets), "word_chars": total[offsets[1:]] - total[offsets[:-1]],
           "n_symbols": np.asarray(pc.fill_null(pc.count_substring_regex(text, SYMBOLS), 0).to_numpy(zero_copy_only=False), np.int64),
           "n_dup_lines": np.zeros(rows, np.int64), "n_repeat_words": np.zeros(rows, np.int64),
           "dup_line_chars": np.zeros(rows, np.int64)}
    for n in rules.ngrams:
        out[f"dup_{n}gram_chars"] = np.zeros(rows, np.int64)
    texts = text.to_numpy(zero_copy_only=False)
    for r in range(rows):
        s, e = offsets[r], offsets[r + 1]
        if e == s:
            continue
        own, width = hashes[s:e], size[s:e]
        if "\n" in texts[r]:
            _, out["n_dup_lines"][r], out["dup_line_chars"][r] = line_facts(texts[r])
        # Nothing longer can repeat where no n-gram of the shortest length does.
        shortest = min(rules.ngrams + (rules.window,))
        if not covered(own, shortest).any():
            continue
        out["n_repeat_words"][r] = covered(own, rules.window).sum()
        for n in rules.ngrams:
            out[f"dup_{n}gram_chars"][r] = width[covered(own, n)].sum()
    return out


def repetition_facts(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), text: str = "text") -> DataFrame:
    """``docs`` with counts per text: words, their characters, symbols,
    repeated lines, words and characters under repeated n-grams (long)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
             *(f"dup_{n}gram_chars" for n in rules.ngrams)]
    keep = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType(keep + [T.StructField(n, T.LongType()) for n in names])
    kept = [f.name for f in keep]
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text, SMALL_SLICE):
                facts = _facts(part.column(text), rules)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + [pa.array(facts[n], pa.int64()) for n in names],
                                                 names=kept + names)

    return docs.select(*[F.col(f"`{k}`") for k in kept]).mapInArrow(work, schema)


def judge(facts: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """Add ``base_failed`` and ``kept``: the base rule on word count and
    repeated windows, then the coverage limits per n-gram length and lines."""
    base = ((F.col("n_words") < rules.min_words)
            | (100 * F.col("n_repeat_words") > rules.max_window_percent * F.col("n_words")))
    good = F.col("dup_line_chars") <= rules.max_line_share * F.col("word_chars")
    for n, share in zip(rules.ngrams, rules.max_ngram_share):
        good = good & (F.col(f"dup_{n}gram_chars") <= share * F.col("word_chars"))
    return facts.withColumn("base_failed", base).withColumn("kept", ~base & good)


def quality_rules(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """Facts and verdict per document, in one map pass over whole texts."""
    return judge(repetition_facts(docs, rules), rules)
