"""Quality rules as a ledger of failure bits.

Each document is measured once and each rule is evaluated once; the ledger holds the measurements and one
bit per failed rule. A policy is a named, versioned set of rules, i.e. a bit mask, so trying another policy
or asking what a rule does to it (ablation) reads the bits and never the texts again.

Defined results: a null text counts as empty; it has no words and fails `few_words`. Repeated rows are
judged one by one. Columns of the input pass through; one that has the name of a ledger column is replaced.
An empty table gives an empty ledger. A text is measured whole, whatever its length.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import arrow_map, replace_columns, utf8, words_of

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger and the SQL condition, over the measurements, under which it is set."""

    name: str
    bit: int
    fails: str


# A rule keeps its bit for good; a changed threshold is a new rule with a new bit.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", 2, "n_symbols > 2 * n_words"),
    Rule("repeated_lines", 3, "n_lines >= 10 and 100 * n_dup_lines > 60 * n_lines"),
    Rule("odd_word_length", 4, "word_chars < 2 * n_words or word_chars > 25 * n_words"),
)
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version of the choice of rules. A document is kept if none of them failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << r.bit for r in RULES if r.name in self.rules)


POLICIES = (
    Policy("1-base", BASE_RULES),
    Policy("2-shape", (*BASE_RULES, "many_symbols", "repeated_lines", "odd_word_length")),
)
CURRENT = POLICIES[-1]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of `window` words that occurs at least twice in the list."""
    if len(words) <= window:
        return 0
    hashes = np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    of_window = np.zeros(len(words) - window + 1, dtype=np.uint64)
    for i in range(window):
        of_window *= factor
        of_window += hashes[i : i + len(of_window)]
    ordered = np.sort(of_window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # Equal windows have equal hashes; the words themselves decide whether the reverse holds, too.
    places = np.flatnonzero(np.isin(of_window, twice))
    texts = [b" ".join(words[i : i + window]) for i in places]
    seen = Counter(texts)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for i, text in zip(places, texts):
        if seen[text] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measurements(text: bytes) -> tuple[int, ...]:
    """The measurements of a text, in the order of MEASURES."""
    words = words_of(text)
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        len(lines),
        repeated_words(words),
    )


def measure(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add the measurements of each text. `carry` names the columns to keep (all of them by default)."""

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [measurements(t) for t in utf8(batch, text)]
        table = np.array(rows, dtype=np.int64).reshape(len(rows), len(MEASURES))
        return {m: pa.array(table[:, i]) for i, m in enumerate(MEASURES)}

    carried = docs.columns if carry is None else carry
    return arrow_map(docs, per_batch, carried, [(m, T.LongType()) for m in MEASURES])


def fail_bits() -> Column:
    return sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("long") for r in RULES), F.lit(0).cast("long"))


def ledger(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The measurements and `fail_bits` of each document, next to its columns."""
    return replace_columns(measure(docs, text, carry), {"fail_bits": fail_bits()})


def passes(policy: Policy = CURRENT) -> Column:
    """Whether the policy keeps a row of a ledger."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def keep(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The documents the policy keeps, with their own columns only."""
    own = [c for c in docs.columns if c.lower() not in {*MEASURES, "fail_bits"}]
    if len(own) < len(docs.columns):
        # Columns named like measurements come back from under a name of their own.
        aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns)}
        held = keep(docs.withColumnsRenamed(aside), policy, aside[text])
        return held.withColumnsRenamed({v: k for k, v in aside.items()})
    return ledger(docs, text).filter(passes(policy)).select(*docs.columns)


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule of it: documents that fail the rule, that the policy rejects, and that only this
    rule rejects, i.e. would return without it. Rows are first counted per bit pattern, of which there are
    at most 2 to the number of rules."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    asked = F.array(*[
        F.struct(
            F.lit(p.version).alias("policy"), F.lit(r.name).alias("rule"), F.lit(p.mask).cast("long").alias("mask"),
            F.lit(1 << r.bit).cast("long").alias("bit"),
        )
        for p in policies for r in RULES if r.name in p.rules
    ])
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    return (
        patterns.select("fail_bits", "n", F.explode(asked).alias("_asked")).select("fail_bits", "n", "_asked.*")
        .groupBy("policy", "rule")
        .agg(
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(failed != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
            F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        )
    )
