"""Variants against all pairs of words, grams and bounds against real edits."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from stockloom.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(docs):
    counts = Counter()
    for id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None)
    return out


def some_docs(seed=2, n=60):
    pick = random.Random(seed)
    letters = "abcdeÀéÿ×"
    base = ["".join(pick.choice(letters) for _ in range(pick.randint(4, 9))) for _ in range(25)]

    def edited(w):
        i = pick.randrange(len(w) + 1)
        return pick.choice([w[:i] + pick.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + pick.choice(letters) + w[i + 1 :]])

    family = base + [edited(w) for w in base for _ in range(6)]
    family += [edited(w) for w in family]
    docs = [(i, " ".join(pick.choice(family[: pick.choice([10, 60, len(family)])]).title() for _ in range(120))) for i in range(n)]
    return docs + [(None, "Abcde abcde. ABCDE"), (7, None), (7, ""), (7, "abcde " * 5000), (8, "x1y_z \n\tĀbcde"), (3, docs[3][1])]


@pytest.mark.parametrize("least", [20, 1])
def test_variants_of_a_small_corpus(spark, monkeypatch, least):
    """`least` 1 makes nearly every gram frequent, so they get as long as they may."""
    monkeypatch.setattr(spelling, "LEAST", least)
    docs = some_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word", "2 AS `near.n`")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(df).collect()}
    want = plain(docs)
    assert got == want
    assert sum(r[0] is not None for r in want.values()) > 50 and any(r[0] != r[1] and r[0] for r in want.values())


def test_words_one_edit_apart_share_an_entry():
    """For any set of frequent grams that holds the beginnings of its members, and any longest length."""
    pick = random.Random(4)
    shared = 0
    for longest in (3, 5):
        spelling.LONGEST, before = longest, spelling.LONGEST
        for _ in range(150):
            letters = "ab" if pick.random() < 0.5 else "abcé"
            words = ["".join(pick.choice(letters) for _ in range(pick.randint(5, 12))) for _ in range(30)]
            chance, frequent = pick.random(), {}
            for w in words:
                s = spelling.BEGIN + w + spelling.END
                for p in range(len(s)):
                    for q in range(2, longest + 1):
                        if p + q > len(s) or pick.random() > chance or q > 2 and s[p : p + q - 1] not in frequent:
                            break
                        frequent[s[p : p + q]] = 1
            numbers = {}
            hashed = lambda g: numbers.setdefault(g, pick.getrandbits(64))

            def entered(word, *kinds):
                return {(min(k, 1), key) for k, key in spelling.entries(word, frequent, hashed) if k in kinds}

            for w in words[:8]:
                i = pick.randrange(len(w) + 1)
                for v in {w[:i] + "a" + w[i:], w[:i] + "b" + w[i + 1 :], w[:i] + w[i + 1 :]} - {w}:
                    short, long = sorted((w, v), key=len)
                    if len(short) == len(long):
                        assert entered(w, spelling.CHANGED) & entered(v, spelling.CHANGED)
                    else:
                        assert entered(short, spelling.SHORTER) & entered(long, spelling.LONGER)
                    shared += 1
        spelling.LONGEST = before
    assert shared > 1000


def test_long_rows_of_forms(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(17)]
    got = dict(spelling.roots(spark.createDataFrame(forms, "word string, form string"), 3 * 2**17).collect())
    assert got == {f"w{i}": "w17" for i in range(17)}


def test_nothing(spark):
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    assert spelling.variants(df).count() == 0
    assert spelling.variants(df.limit(0)).count() == 0
