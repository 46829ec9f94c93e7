"""Measurements against a plain count, and what policies make of the bits."""

import random
import re

import pytest

from stockloom.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plainly(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(lines), len(covered),
    )


def samples():
    pick = random.Random(5)
    out = ["", " \n\t ", "a", "é ü x", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "# $ %%\n# $ %%\n\n"]
    for _ in range(60):
        words = ["w%d" % pick.randint(0, pick.choice([3, 200])) for _ in range(pick.randint(1, 90))]
        text = "".join(w + pick.choice([" ", "  ", "\n", "\t", " # "]) for w in words)
        out.append(text + (text if pick.random() < 0.3 else ""))
    return out


@pytest.mark.parametrize("text", samples())
def test_measurements_equal_a_plain_count(text):
    assert q.measurements(text.encode()) == plainly(text)


def test_a_very_long_text_is_measured_whole():
    text = "lorem ipsum dolor sit amet consectetur adipiscing elit sed " * 40_000
    n_words, *_, n_repeat = q.measurements((text + "tail end of it").encode())
    assert n_words == 360_004
    assert n_repeat == 360_000


def test_ledger_handles_nulls_repeats_and_clashing_columns(spark):
    good = " ".join(f"word{i}" for i in range(50))
    rows = [(1, good, "en"), (1, good, "en"), (None, None, None), (2, "", "de"), (3, "x " * 30, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS n_words", "7 AS FAIL_BITS")
    got = {(r["doc_id"], r["n_words"], r["fail_bits"] & 3) for r in q.ledger(docs).collect()}
    assert got == {(1, 50, 0), (None, 0, 1), (2, 0, 1), (3, 30, 2)}
    kept = q.keep(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(1, good, "en", "mine", 7)] * 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert q.ledger(docs).count() == 0
    assert q.keep(docs).columns == docs.columns
    assert q.ablations(q.ledger(docs)).count() == 0


def test_ablations_count_what_only_one_rule_rejects(spark):
    bits = spark.createDataFrame([(b,) for b in [0, 0, 1, 3, 2, 2, 4, 5]], "fail_bits long")
    rows = {(r["policy"], r["rule"]): (r["n_failed"], r["n_rejected"], r["n_only_this"]) for r in q.ablations(bits).collect()}
    assert rows["1-base", "few_words"] == (3, 5, 2)  # 5 = few words and many symbols: the base asks for the first only
    assert rows["1-base", "repeated_words"] == (3, 5, 2)
    assert rows["2-shape", "few_words"] == (3, 6, 1)
    assert rows["2-shape", "many_symbols"] == (2, 6, 1)


def test_bits_are_unique():
    assert len({r.bit for r in q.RULES}) == len(q.RULES) == len({r.name for r in q.RULES})
