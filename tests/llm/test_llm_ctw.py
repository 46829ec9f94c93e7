"""The model against a direct context tree, and what makes its scores probabilities."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockloom.llm import ctw

DEPTH = 3


def plain_tree(texts, depth):
    """Counts per (context, bits so far), and log Pw, by the definition."""
    counts = defaultdict(lambda: [0, 0])
    for data in texts:
        padded = b"\n" * depth + data
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                context = padded[i - d : i][::-1]
                for j in range(8):
                    counts[context, 1 << j | padded[i] >> (8 - j)][padded[i] >> (7 - j) & 1] += 1

    def log_kt(a, b):
        g = math.lgamma
        return g(a + 0.5) + g(b + 0.5) - g(a + b + 1) - math.log(math.pi)

    children = defaultdict(list)
    for context, bits in counts:
        if context:
            children[context[:-1], bits].append((context, bits))
    log_pw = {}

    def weighted(node):
        kt = log_kt(*counts[node])
        if len(node[0]) == depth:
            log_pw[node] = (kt, 1.0)
        else:
            below = sum(weighted(c) for c in children[node])
            pw = math.log(0.5) + np.logaddexp(kt, below)
            log_pw[node] = (pw, math.exp(kt + math.log(0.5) - pw))
        return log_pw[node][0]

    for node in [n for n in counts if not n[0]]:
        weighted(node)
    return counts, log_pw


def plain_score(data, counts, log_pw, depth):
    padded, total = b"\n" * depth + data, 0.0
    for i in range(depth, len(padded)):
        for j in range(8):
            bit, bits = padded[i] >> (7 - j) & 1, 1 << j | padded[i] >> (8 - j)
            eta, deeper = 0.5, False
            for d in range(depth, -1, -1):
                node = (padded[i - d : i][::-1], bits)
                if node in log_pw:
                    n = counts[node]
                    p = (n[bit] + 0.5) / (sum(n) + 1)
                    w = log_pw[node][1] if deeper else 1.0
                    eta, deeper = w * p + (1 - w) * eta, True
            total += math.log10(eta)
    return total


def samples():
    pick = random.Random(6)
    words = ["the", "tHe", "then", "né", "x" * 30, "of", "ab", "ba"]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(0, 30)))) for i in range(40)]
    rows += [(None, "the lost"), (None, None), (3, None), (3, ""), (3, "the\tof \n\x0b the"), (77, " wide space"), (77, " wide space")]
    return rows


def test_scores_equal_the_definition(spark):
    rows = samples()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS run", "2 AS score", "3 AS held_out")
    got = Counter()
    for r in ctw.score(docs, depth=DEPTH).collect():
        got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)] += 1
    texts = [(id, (text or "").encode().lower().split()) for id, text in rows]
    held = [zlib.crc32(b"" if id is None else str(id).encode()) % 10 == 0 for id, _ in texts]
    assert any(held) and not all(held)
    train = [ws for (_, ws), h in zip(texts, held) if not h]
    counts = Counter(w for ws in train for w in [*ws, b"\n"])
    n, v = sum(counts.values()), len(counts)
    tree = plain_tree([b" ".join(ws) + b"\n" for ws in train], DEPTH)
    want = Counter()
    for (id, ws), h in zip(texts, held):
        tokens = [*ws, b"\n"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        score = plain_score(b" ".join(ws) + b"\n", *tree, DEPTH)
        want[id, h, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6), round(score, 6)] += 1
    assert got == want


def test_predictions_add_up_to_one():
    train = np.concatenate([ctw.grams_of(b"the cat sat on the mat\n", 4), ctw.grams_of(b"then the hat\n", 4)])
    grams, counts = np.unique(train, return_counts=True)
    levels = ctw.subtree(grams, counts, 4, 0)
    for context in [b"the ", b"\n\n\n\n", b"zzzz", b" cat", bytes([0, 255, 1, 2])]:
        every = np.concatenate([ctw.grams_of(context + bytes([x]), 4)[-1:] for x in range(256)])
        assert abs((10.0 ** ctw.score_grams(every, levels, 4)).sum() - 1) < 1e-9


def test_a_text_like_the_training_texts_scores_better(spark):
    pick = random.Random(2)
    words = [f"{a}{b}" for a in ("ta", "ri", "mo", "sel") for b in ("na", "ku", "dor", "vi")]
    rows = [(i, " ".join(pick.choice(words) for _ in range(60))) for i in range(60)]
    noise = [(1000 + i, " ".join("".join(pick.choice("qxzjwkvb") for _ in range(5)) for _ in range(60))) for i in range(60)]
    noise = [(i, t) for i, t in noise if ctw.held_out(i)]
    got = {r["doc_id"]: r for r in ctw.score(spark.createDataFrame(rows + noise, "doc_id long, text string")).collect()}
    held = [r["bits_per_byte"] for i, r in got.items() if i < 1000 and r["held_out"]]
    assert held and max(held) < 1.6
    assert min(got[i]["bits_per_byte"] for i, _ in noise) > 4


def test_no_training_texts_and_empty_table(spark):
    only = next(i for i in range(1000) if ctw.held_out(i))
    (r,) = ctw.score(spark.createDataFrame([(only, "ab")], "doc_id long, text string")).collect()
    assert r["train_tokens"] == 0 and r["n_known"] == 0
    assert abs(r["score"] - 24 * math.log10(0.5)) < 1e-12 and abs(r["base_score"] - 2 * math.log10(0.1 / 0.1)) < 1e-12
    assert ctw.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 2.0, 7.5, 100.0, 1e6, 1e12])
    want = np.array([math.lgamma(v) for v in x])
    assert np.allclose(ctw._log_gamma(x), want, rtol=1e-12, atol=1e-10)


@pytest.mark.parametrize("size", [1 << 10, 1 << 20])
def test_a_long_text_in_stretches(spark, monkeypatch, size):
    monkeypatch.setattr(ctw, "STRETCH", size)
    rows = [(i, "many words in a row " * 500) for i in (1, 2, 3)]
    scores = {round(r["score"], 6) for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string"), depth=2).collect()}
    assert len(scores) == 1
