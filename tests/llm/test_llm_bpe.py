"""The automaton against the tokenizers library, and the round trip."""

import hashlib
import itertools
import json
import pickle
import random
import struct

import pytest

from stockloom.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def strings():
    pick = random.Random(9)
    letters = [chr(c) for c in [*range(0x250), 0x4E2D, 0x1F600, 0x3042, 0x430, 0x5D0, 0x200D, 0x2028, 0x85, 0x1C, 0x660, 0xFEFF, 0x1D7D8]]
    out = ["", " ", "\n\n", "a" * 3000, "ab" * 1500, "=" * 999, " " * 700, "don't I'll they've", "<|endoftext|>", "x<|endoftext|><|endoftext|> y"]
    for _ in range(3000):
        out.append("".join(pick.choice(letters if pick.random() < 0.3 else "aabbeeth ins'\n\t 10.é") for _ in range(pick.randint(1, 40))))
    return out


def test_ids_equal_the_library(automaton, library):
    for text in strings():
        assert bpe.tokens(automaton.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_decoding_emits_the_labels(automaton, library):
    for text in strings():
        assert automaton.decode(bpe.tokens(automaton.encode(text))) == text
    pick = random.Random(3)
    for _ in range(200):
        ids = [pick.randint(0, 50256) for _ in range(12)]
        spelled = b"".join(automaton.labels[i] for i in ids)
        assert automaton.decode(ids) == spelled.decode("utf-8", "replace")


def test_a_word_has_one_path(automaton):
    """Of all ways to spell a word by tokens, exactly one follows the arcs, and it is the encoding."""

    def spellings(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if (t := automaton.token.get(word[:n])) is not None:
                yield from ([t, *rest] for rest in spellings(word[n:]))

    for word in [b"lower", b" theren", b"aaaaaa", b"xqzjw", b"1000001", "naïve".encode()]:
        paths = [p for p in spellings(word) if all(automaton.arc(a, b) for a, b in zip(p, p[1:]))]
        assert paths == [automaton.encode_word(word)]


def test_the_kept_words_may_be_dropped(automaton, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    text = "one two three four five six seven one two three"
    assert automaton.decode(bpe.tokens(automaton.encode(text))) == text


def test_documents(spark, library):
    rows = [(1, "Hello world"), (2, None), (2, ""), (None, "again again"), (1, "Hello world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS n_tokens", "'x' AS `a.b`")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(docs, PATH).collect())
    want = []
    for id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((id or 0, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    encoded = bpe.encode(docs, PATH)
    back = bpe.decode(encoded, PATH).selectExpr("coalesce(text, '') = decoded AS same").collect()
    assert all(r["same"] for r in back) and len(back) == 5
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def small_vocabulary(pick, letters="abc", size=9):
    """Random merges over a few letters; some can never happen, some have the same result."""
    ids, merges = {c: i for i, c in enumerate(letters)}, []
    while len(merges) < size:
        a, b = pick.choice(list(ids)), pick.choice(list(ids))
        if [a, b] not in merges:
            merges.append([a, b])
            ids.setdefault(a + b, len(ids))
    return ids, merges


def plain_automaton(ids, merges):
    """Gadget by gadget, with a state for every token and the arcs of each state as a set."""
    arcs = {"": {t for t in ids if len(t) == 1}}
    arcs |= {t: set(arcs[""]) for t in arcs[""]}
    for u, v in merges:
        if u in arcs and v in arcs and v in arcs[u]:
            before = set(arcs[v])
            arcs[u].discard(v)
            if u + v not in arcs:
                arcs[u + v] = before
                for state in arcs.values():
                    if u in state:
                        state.add(u + v)
    return arcs


def merged(word, merges):
    """The merges one after another, each from the left."""
    parts = list(word)
    for u, v in merges:
        i = 0
        while i + 1 < len(parts):
            if parts[i] == u and parts[i + 1] == v:
                parts[i : i + 2] = [u + v]
            i += 1
    return parts


def test_states_and_arcs_equal_a_plain_construction():
    pick = random.Random(21)
    for _ in range(60):
        ids, merges = small_vocabulary(pick)
        if len({a + b for a, b in merges}) < len(merges):
            continue  # two merges with one result: the plain merging below has no rule for it
        built = bpe.Automaton(json.dumps({"model": {"vocab": ids, "merges": merges}}))
        arcs = plain_automaton(ids, merges)
        assert {t.decode() for t in built.token} == set(arcs) - {""}
        for before, after in itertools.product(arcs, set(arcs) - {""}):
            state = built.states[ids[before]] if before else bpe.START
            assert built.has_arc(state, ids[after]) == (after in arcs[before]), (merges, before, after)
        # As few states as gadgets make: tokens with the same arcs may share, tokens with others never do.
        assert built.table.shape[1] <= len(arcs)
        again = pickle.loads(pickle.dumps(built))
        for n in range(1, 7):
            for word in map("".join, itertools.product("abc", repeat=n)):
                want = [ids[t] for t in merged(word, merges)]
                assert built.encode_word(word.encode()) == want == again.encode_word(word.encode()), (merges, word)
