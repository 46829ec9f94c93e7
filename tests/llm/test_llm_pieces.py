"""Pieces, spans and decoding against the sentencepiece library, normalisation against its compiled rules."""

import hashlib
import random
import struct

import pytest

from stockloom.llm import pieces

library_module = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.read_model(PATH))


@pytest.fixture(scope="module")
def library():
    return library_module.SentencePieceProcessor(model_file=PATH)


def strings(n=1500):
    pick = random.Random(9)
    letters = [chr(c) for c in [*range(0x250), 0x4E2D, 0x1F600, 0x3042, 0x430, 0x5D0, 0x200D, 0x2028, 0x85, 0x1C, 0x660, 0xFEFF, 0x1D7D8, 0x2581, 0xFFFD, 0x301]]
    out = ["", " ", "  ", "\n\n", "a" * 3000, "ab" * 1500, "=" * 999, " " * 700, "<s>", "</s> <unk>", "<0x41>", "▁", "▁▁ x", "don't I'll", "é ﬁ ½ Ａ　Ｂ"]
    for _ in range(n):
        out.append("".join(pick.choice(letters if pick.random() < 0.3 else "aabbeeth ins'\n\t 10.é") for _ in range(pick.randint(1, 40))))
    return out


def spans(library, text):
    """(id, first byte, end) of every piece as the library reports them."""
    out = []
    for number, value in pieces.fields(library.encode(text, out_type="serialized_proto")):
        if number == 2:
            piece = dict(pieces.fields(value))
            out.append((piece.get(2, 0), piece.get(4, 0), piece.get(5, 0)))
    return out


def test_ids_and_spans_equal_the_library(model, library):
    texts = strings()
    for text, (ids, first, last) in zip(texts, model.encode_all([t.encode() for t in texts])):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text)
        assert list(zip(ids.tolist(), first.tolist(), last.tolist()))[1:-1] == spans(library, text), repr(text)


def test_decoding_equals_the_library(model, library):
    for text in strings(300):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert model.decode(ids) == library.decode(ids)
    pick = random.Random(3)
    for _ in range(500):
        ids = [pick.randint(0, 31999) if pick.random() < 0.5 else pick.randint(3, 258) for _ in range(pick.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix,squeeze,escape", [(1, 1, 1), (0, 0, 0), (1, 0, 1), (0, 1, 1)])
def test_compiled_character_maps(rule, prefix, squeeze, escape):
    """Longest keys, and the source place of every byte written, for maps that really rewrite."""
    normaliser = library_module.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=bool(prefix), remove_extra_whitespaces=bool(squeeze), escape_whitespaces=bool(escape))
    spec = dict(pieces.fields(normaliser.serialized_normalizer_spec()))
    ours = pieces.Normaliser(pieces.Rules(spec[2], bool(prefix), bool(squeeze), bool(escape)))
    for text in strings(500):
        want, places = normaliser.normalize(text, with_offsets=True)
        spelled, origin = ours(text.encode())
        assert spelled.decode() == want, repr(text)
        if len(text) < 100:  # the library counts characters
            starts = [k for k in range(len(spelled)) if spelled[k] & 0xC0 != 0x80] + [len(spelled)]
            assert [len(text.encode()[: origin[k]].decode()) for k in starts] == list(places), repr(text)


def test_symbols_kept_whole_and_pieces_not_used():
    """User symbols are never cut or joined; a piece that must not be used falls apart again."""
    model = pieces.Model(pieces.read_model(PATH))
    model.kinds[model.id_of["▁the"]] = pieces.UNUSED
    model.unused = {"▁the"}
    model.special = True
    ids, first, last = model.encode(b"the cat")
    assert model.id_of["▁the"] not in ids.tolist()
    assert model.decode(ids) == "the cat" and int((last - first).sum()) == 7
    normaliser = pieces.Normaliser(pieces.Rules(squeeze=False, whole=(b"<a b>",)))
    assert normaliser(b"x<a b>")[0] == "▁x<a▁b>".encode()


def test_unknown_neighbours_are_one_piece(model):
    codes = [(7, 1), (0, 3), (0, 2), (9, 1), (0, 1)]
    joined = model.joined_unknowns(pieces.np.array([i << pieces.WIDTH_BITS | w for i, w in codes]))
    assert [(c >> pieces.WIDTH_BITS, c & 255) for c in joined.tolist()] == [(7, 1), (0, 5), (9, 1), (0, 1)]


def test_the_kept_words_may_be_dropped(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 3)
    monkeypatch.setattr(pieces, "GROUP_BYTES", 10)
    model = pieces.Model(pieces.read_model(PATH))
    texts = ["one two three four five six seven one two three", "one two", "", "x" * 500]
    assert [m[0].tolist() for m in model.encode_all([t.encode() for t in texts])] == [
        library.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_documents(spark, library):
    long = "lang " * 60_000
    rows = [(1, "Hello world"), (2, None), (2, ""), (None, "again  again"), (1, "Hello world"), (3, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS n_tokens", "'x' AS `a.b`")
    got = sorted((r["doc_id"] or 0, *r[1:]) for r in
                 pieces.round_trip(docs, PATH, carry=["doc_id"]).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes").collect())
    want = []
    for id, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((id or 0, len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest(), len(text or "")))
    assert got == sorted(want)
    encoded = pieces.encode(docs, PATH)
    assert {"a.b", "n_tokens", "piece_ids", "piece_starts", "piece_ends"} <= set(encoded.columns)
    back = pieces.decode(encoded, PATH).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back) and len(back) == 6
    first = next(r for r in back if r["text"] == "Hello world")
    assert "".join(first["text"][a:b] for a, b in zip(first["piece_starts"], first["piece_ends"])) == "Hello world"
    assert pieces.encode(docs.limit(0), PATH).count() == 0
