"""SentencePiece encoding and decoding that keeps, for every piece, the bytes of the text it stands for.

A text is first normalised: at each place the longest key of the model's character map that begins there is
replaced by its value, and every byte written remembers the place in the original text it came from. The map is
a double array, walked byte by byte; where its table of first two bytes shows that no key can begin, bytes are
copied in stretches. Pieces are then merged, best score first, leftmost among equals, on the normalised text,
and their ends are looked up in the alignment, which gives spans of original bytes. A character without a
piece becomes its bytes; the last of them carries the span. Decoding joins the labels.

Merges never cross the border of a word if no piece has a space mark behind another character, which is read
off the vocabulary. Words already merged are kept up to a bound. A vocabulary without that property is encoded
text by text with the same merges.

Defined results: a null text is empty and has the begin and end ids only. Texts are encoded whole, of any
length. Repeated rows are encoded one by one, null ids pass through, input columns stay unless a result has
their name; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stockloom.llm.common import arrow_map, utf8

# The mark that stands for a space, and the kinds of pieces in a model file.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2

#: Words a worker keeps at most (or those of one group of texts, if they are more); beyond that it starts over.
KEPT_WORDS = 400_000

#: Words up to this length are merged many at a time and kept.
SHORT_WORD = 64
#: Texts whose words are merged together have about this many bytes.
GROUP_BYTES = 2 << 20
NEVER = 1 << 30
NUMBER_BITS = 24  # enough for the pieces of a vocabulary

WIDTH_BITS = 32  # a code is a piece id and, below it, the normalised bytes consumed with it


def fields(message: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a protocol-buffer message; fixed-width values stay bytes."""
    at, end = 0, len(message)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield key >> 3, message[at : at + size]
        at += size


@dataclass(frozen=True)
class Rules:
    """How a model normalises texts."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True  # spaces at the ends go, runs become one
    escape: bool = True  # spaces are written as marks
    suffix: bool = False  # the added space stands at the end
    whole: tuple[bytes, ...] = ()  # symbols no rule may touch


class Normaliser:
    def __init__(self, rules: Rules):
        self.rules = rules
        size = int.from_bytes(rules.charsmap[:4], "little")
        self.units = np.frombuffer(rules.charsmap[4 : 4 + size], "<u4").tolist()
        self.values = rules.charsmap[4 + size :]
        self.whole = sorted(rules.whole, key=len, reverse=True)
        self.may_begin = np.zeros((256, 256), bool)
        if self.units:
            for first in range(256):
                node, leaf = self.follow(self.start(), first)
                if node is None:
                    continue
                if leaf is not None:
                    self.may_begin[first] = True
                else:
                    self.may_begin[first] = [self.follow(node, second)[0] is not None for second in range(256)]
        for symbol in self.whole:
            self.may_begin[symbol[0]] = True

    def start(self) -> int:
        return self.jump(0, self.units[0])

    @staticmethod
    def jump(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def follow(self, node: int, byte: int) -> tuple[int | None, int | None]:
        """(next node, value of a key that ends here) along the arc of a byte; (None, None) without one."""
        node ^= byte
        if node >= len(self.units):
            return None, None
        unit = self.units[node]
        if unit & 0x800000FF != byte:
            return None, None
        node = self.jump(node, unit)
        return node, (self.units[node] & 0x7FFFFFFF if unit >> 8 & 1 else None)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, what to write) for the longest key at a place; symbols kept whole come first."""
        for symbol in self.whole:
            if text.startswith(symbol, at):
                return len(symbol), symbol
        found = None
        if self.units:
            node = self.start()
            for i in range(at, len(text)):
                node, value = self.follow(node, text[i])
                if node is None:
                    break
                if value is not None:
                    found = i + 1 - at, value
        if found is None:
            return None
        size, value = found
        return size, self.values[value : self.values.index(0, value)]

    def rewritten(self, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """The bytes after all replacements, for each the original place its character begins at, and the place of
        the first key replaced by nothing (the end of the text if there is none)."""
        raw = np.frombuffer(text, np.uint8)
        places = np.arange(len(raw), dtype=np.int64)
        first = (raw & 0xC0) != 0x80
        origin = np.maximum.accumulate(np.where(first, places, 0)) if len(raw) else places
        following = np.append(raw[1:], 0)
        busy = np.flatnonzero(first & self.may_begin[raw, following]).tolist() if len(raw) else []
        written, origins, done, gone = [], [], 0, len(text)
        for at in busy:
            if at < done or (found := self.longest(text, at)) is None:
                continue
            size, value = found
            if not value:
                gone = min(gone, at)
            written += [raw[done:at], np.frombuffer(value, np.uint8)]
            origins += [origin[done:at], np.full(len(value), at, np.int64)]
            done = at + size
        if not written:
            return raw, origin, gone
        return np.concatenate([*written, raw[done:]]), np.concatenate([*origins, origin[done:]]), gone

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the place in the original text."""
        rules, end = self.rules, len(text)
        nothing = b"", np.zeros(1, np.int64)
        if not text:
            return nothing
        out, origin, gone = self.rewritten(text)
        blank = out == 0x20
        lead = 0
        if rules.squeeze:
            if gone == end and blank.all():
                return nothing
            kept = ~(blank & np.concatenate([[True], blank])[: len(blank)])
            out, origin, blank = out[kept], origin[kept], blank[kept]
            lead = min(gone, int(origin[0]) if len(origin) else end)
        mark = MARK.encode() if rules.escape else b" "
        spelled = out.tobytes()
        if rules.escape:
            origin = np.repeat(origin, np.where(blank, len(mark), 1))
            spelled = spelled.replace(b" ", mark)
        if rules.dummy_prefix and not rules.suffix:
            spelled, origin = mark + spelled, np.concatenate([np.full(len(mark), lead, np.int64), origin])
        while rules.squeeze and spelled.endswith(mark):  # at most one from a blank, and marks in the text itself
            end = int(origin[len(spelled) - len(mark)])
            spelled = spelled[: -len(mark)]
        origin = origin[: len(spelled)]
        if rules.dummy_prefix and rules.suffix:
            spelled, origin = spelled + mark, np.concatenate([origin, np.full(len(mark), end, np.int64)])
        return spelled, np.append(origin, end)


class Pairs:
    """Which neighbours make a piece, as sorted tables, to merge many words at a time."""

    def __init__(self, score: dict[str, float], ids: dict[str, int]):
        letters = {c for s in score for c in s}
        self.named = sorted(letters | set(score))
        number = {s: i for i, s in enumerate(self.named)}
        places = {v: i for i, v in enumerate(sorted(set(score.values()), reverse=True))}
        made = []
        for s, v in score.items():
            for i in range(1, len(s)):
                if s[:i] in number and s[i:] in number:
                    made.append((number[s[:i]] << NUMBER_BITS | number[s[i:]], places[v], number[s]))
        table = np.array(sorted(made), np.int64).reshape(-1, 3)
        self.keys, self.place, self.result = np.append(table[:, 0], 1 << 62), table[:, 1], table[:, 2]
        self.of_letter = np.full(0x110000, len(self.named), np.int64)  # the last number: a letter no piece has
        for c in letters:
            self.of_letter[ord(c)] = number[c]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place by score, number of the joined piece) of neighbours; NEVER where they make none."""
        wanted = left << NUMBER_BITS | right
        at = np.searchsorted(self.keys, wanted)
        found = self.keys[at] == wanted
        at = np.where(found, at, 0)
        return np.where(found, self.place[at], NEVER), self.result[at]

    def merged(self, words: list[str]) -> list[list[int]]:
        """The numbers of the pieces of every word. In each round every word joins its best pair, the leftmost of
        equals, until it has none."""
        out: list[list[int]] = [[] for _ in words]
        if not words or not len(self.place):
            return [self.of_letter[[ord(c) for c in w]].tolist() for w in words]
        part = self.of_letter[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        place, joined = self.look_up(part, np.append(part[1:], 0))
        place[np.append(word[1:] != word[:-1], True)] = NEVER
        while len(part):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(part)))
            best = np.minimum.reduceat(place, starts)
            done = best == NEVER
            if done.any():
                gone = np.repeat(done, sizes)
                values = part[gone].tolist()
                at = 0
                for w, size in zip(word[starts[done]].tolist(), sizes[done].tolist()):
                    out[w] = values[at : at + size]
                    at += size
                part, word, place, joined = part[~gone], word[~gone], place[~gone], joined[~gone]
                if not len(part):
                    break
                best, sizes = best[~done], sizes[~done]
            equal = np.flatnonzero(place == np.repeat(best, sizes))
            at = equal[np.append(True, word[equal[1:]] != word[equal[:-1]])]
            part[at] = joined[at]
            kept = np.ones(len(part), bool)
            kept[at + 1] = False
            part, word, place, joined = part[kept], word[kept], place[kept], joined[kept]
            at -= np.arange(len(at))  # one part before each has gone per word
            place[at] = NEVER
            for i in (at[at > 0] - 1, at[at + 1 < len(part)]):
                i = i[word[i] == word[i + 1]]
                place[i], joined[i] = self.look_up(part[i], part[i + 1])
        return out

    def spelled(self, word: str, numbers: list[int]) -> list[str]:
        """The pieces of a word by name; a letter no piece has stands for itself."""
        out, at = [], 0
        for n in numbers:
            size = len(self.named[n]) if n < len(self.named) else 1
            out.append(word[at : at + size])
            at += size
        return out


class Model:
    """One model file, ready to encode and decode."""

    def __init__(self, content: bytes):
        self.spelling: list[str] = []
        self.score: dict[str, float] = {}
        self.kinds: list[int] = []
        scores = []
        trainer: dict[int, bytes | int] = {}
        norm: dict[int, bytes | int] = {}
        for number, value in fields(content):
            if number == 1:
                piece = dict(fields(value))
                self.spelling.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
        if trainer.get(3, 1) != BPE_MODEL:
            raise ValueError("only models of pair merges are supported")
        self.id_of = {s: i for i, s in enumerate(self.spelling)}
        merged = {i for i, k in enumerate(self.kinds) if k in (NORMAL, USER, UNUSED)}
        self.score = {self.spelling[i]: scores[i] for i in merged}
        self.unused = {self.spelling[i] for i in merged if self.kinds[i] == UNUSED}
        self.unknown = self.kinds.index(UNKNOWN)
        self.fallback = bool(trainer.get(35, 0))
        self.byte_ids = {int(self.spelling[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.begin = self.id_of.get(trainer.get(46, b"<s>").decode())
        self.end = self.id_of.get(trainer.get(47, b"</s>").decode())
        surface = trainer.get(44, " ⁇ ".encode())
        whole = [self.spelling[i] for i in merged if self.kinds[i] == USER]
        self.rules = Rules(
            norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1)), bool(trainer.get(24, 0)),
            tuple(s.encode() for s in whole),
        )
        self.normalise = Normaliser(self.rules)
        self.symbols = re.compile("|".join([*map(re.escape, sorted(whole, key=len, reverse=True)), "."]), re.DOTALL).findall
        self.special = bool(whole or self.unused)
        self.pairs = Pairs(self.score, self.id_of)
        self.cut = self.word_border()
        self.codes = [i << WIDTH_BITS | len(s.encode()) for i, s in enumerate(self.spelling)]
        self.code_of = [self.codes[self.id_of[name]] if name in self.id_of else None for name in self.pairs.named] + [None]
        self.kept: dict[str, tuple[int, ...]] = {}
        self.labels = [self.label(i, surface) for i in range(len(self.spelling))]
        self.is_byte = np.array([k == BYTE for k in self.kinds])

    def word_border(self) -> str | None:
        """On which side of a space mark no merge can cross, or None if merges cross both."""
        inner = [s for s in self.score if len(s) > 1]
        if not any(MARK in s.lstrip(MARK) for s in inner):
            return "before"
        return None if any(MARK in s.rstrip(MARK) for s in inner) else "after"

    def label(self, i: int, surface: bytes) -> bytes:
        kind, spelled = self.kinds[i], self.spelling[i]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return surface
        return bytes([int(spelled[3:5], 16)]) if kind == BYTE else spelled.replace(MARK, " ").encode()

    def merge(self, word: str) -> list[str]:
        """The pieces of a word: neighbours with the best score join until none has one."""
        parts = self.symbols(word)
        score = self.score
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        frozen = [len(p) > 1 for p in parts]
        halves: dict[str, tuple[str, str]] = {}
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left < 0 or right >= len(parts) or frozen[left] or frozen[right]:
                return
            joined = parts[left] + parts[right]
            found = score.get(joined)
            if found is not None:
                heapq.heappush(agenda, (-found, left, right, joined))
                if joined in self.unused:
                    halves[joined] = parts[left], parts[right]

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != len(joined):
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[right] < len(parts):
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])

        def settled(piece: str) -> list[str]:
            if piece in self.unused and piece in halves:
                return [p for half in halves[piece] for p in settled(half)]
            return [piece]

        return [p for part in parts if part for p in (settled(part) if halves else (part,))]

    def encode_word(self, word: str) -> tuple[int, ...]:
        """The codes of a word: id and consumed normalised bytes of every piece."""
        return self.codes_for(self.merge(word))

    def codes_for(self, parts: list[str]) -> tuple[int, ...]:
        codes: list[int] = []
        for piece in parts:
            i = self.id_of.get(piece, self.unknown)
            if i != self.unknown:
                codes.append(self.codes[i])
                continue
            spelled = piece.encode()
            if self.fallback:
                codes += [self.byte_ids[b] << WIDTH_BITS for b in spelled]
                codes[-1] |= len(spelled)
            else:
                codes.append(i << WIDTH_BITS | len(spelled))
        return tuple(codes)

    def joined_unknowns(self, codes: np.ndarray) -> np.ndarray:
        """Neighbouring unknown characters are one piece."""
        unknown = codes >> WIDTH_BITS == self.unknown
        again = unknown & np.concatenate([[False], unknown[:-1]])
        if not again.any():
            return codes
        starts = np.flatnonzero(~again)
        widths = np.add.reduceat(codes & ((1 << WIDTH_BITS) - 1), starts)
        return codes[starts] >> WIDTH_BITS << WIDTH_BITS | widths

    def borders(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where the words of some joined texts begin; each text begins one."""
        if self.cut is None or len(raw) < 3:
            return starts
        mark = np.zeros(len(raw), bool)
        mark[:-2] = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)  # the bytes of MARK
        at = np.flatnonzero(mark)
        if self.cut == "before":
            at = at[(at < 3) | ~mark[at - 3]]
        else:
            at = at + 3
            at = at[at < len(raw)]
            at = at[~mark[at]]
        begins = np.zeros(len(raw), bool)
        begins[at] = True
        begins[starts[starts < len(raw)]] = True
        return np.flatnonzero(begins)

    def codes_of_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """The codes of different words; those not kept yet are merged together."""
        kept = self.kept
        if len(kept) + len(words) > KEPT_WORDS and any(w not in kept for w in words):
            kept.clear()
        missing = [w for w in words if w not in kept]
        short = [] if self.special else [w for w in missing if len(w) <= SHORT_WORD]
        for word, numbers in zip(short, self.pairs.merged(short)):
            codes = tuple([self.code_of[n] for n in numbers])
            kept[word] = self.codes_for(self.pairs.spelled(word, numbers)) if None in codes else codes
        others = {w: self.encode_word(w) for w in missing if w not in kept}
        return [kept[w] if w in kept else others[w] for w in words]

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first bytes, ends) with the begin and end ids, whose spans are empty."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        group, size = [], 0
        for i, text in enumerate(texts, 1):
            group.append((*self.normalise(text), len(text)))
            size += len(text)
            if size >= GROUP_BYTES or i == len(texts):
                yield from self.encode_group(group)
                group, size = [], 0

    def encode_group(self, group: list[tuple[bytes, np.ndarray, int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Encode normalised texts: every different word of them once."""
        joined = b"".join([g[0] for g in group])
        text_ends = np.cumsum([len(g[0]) for g in group])
        raw = np.frombuffer(joined, np.uint8)
        starts = self.borders(raw, np.unique(np.append(0, text_ends[:-1]))) if joined else np.zeros(0, np.int64)
        starts = starts[starts < len(raw)]
        offsets = np.append(starts, len(raw)).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(joined)).dictionary_encode()
        codes = self.codes_of_words(words.dictionary.to_pylist())
        flat = np.fromiter(chain.from_iterable(codes), np.int64)
        sizes = np.array([len(c) for c in codes], np.int64)
        order = words.indices.to_numpy(zero_copy_only=False)
        counts = sizes[order]
        begun = np.concatenate([[0], np.cumsum(counts)])
        first = np.cumsum(sizes)[order] - counts
        flat = flat[np.repeat(first - begun[:-1], counts) + np.arange(begun[-1])]
        upto = begun[np.searchsorted(starts, text_ends)]
        done = 0
        for (_, origin, n_bytes), until in zip(group, upto.tolist()):
            own = flat[done:until] if self.fallback else self.joined_unknowns(flat[done:until])
            done = until
            widths = own & ((1 << WIDTH_BITS) - 1)
            ends = np.cumsum(widths)
            ids = np.concatenate([[self.begin], own >> WIDTH_BITS, [self.end]]).astype("<u4")
            yield ids, np.concatenate([[0], origin[ends - widths], [n_bytes]]), np.concatenate([[0], origin[ends], [n_bytes]])

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Join the labels; the space added in front goes again."""
        ids = list(ids) if not isinstance(ids, np.ndarray) else ids.tolist()
        labels, kinds = self.labels, self.kinds
        at = 0
        while at < len(ids) and kinds[ids[at]] == CONTROL:
            at += 1
        drop = 0
        if (self.rules.dummy_prefix or self.rules.squeeze) and at < len(ids) and kinds[ids[at]] not in (BYTE, UNKNOWN):
            if self.rules.squeeze:  # every space in front goes
                joined = b"".join([labels[i] for i in ids[at:]])
                drop = len(joined) - len(joined.lstrip(b" "))
            elif labels[ids[at]].startswith(b" "):
                drop = 1
        joined = b"".join([labels[i] for i in ids])[drop:]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return decoded_bytewise(joined)


def decoded_bytewise(spelled: bytes) -> str:
    """Bytes that are no UTF-8 become one replacement character each."""
    out, at = [], 0
    while at < len(spelled):
        try:
            out.append(spelled[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out.append(spelled[at : at + wrong.start].decode())
            out.append("�")
            at += wrong.start + 1
    return "".join(out)


@lru_cache(maxsize=2)
def loaded(content: bytes) -> Model:
    """Read once per worker and model."""
    return Model(content)


def read_model(path: str) -> bytes:
    """The model file, read on the driver; its size does not depend on the corpus. Sent to the workers."""
    with open(path, "rb") as f:
        return f.read()


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def encode(docs: DataFrame, model_path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add `piece_ids` (array of int), `piece_starts` and `piece_ends` (arrays of long: the bytes of the original
    text each piece stands for) to each document. `carry`: columns to keep, all by default."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = loaded(shared.value)
        rows = list(model.encode_all(list(utf8(batch, text))))
        return {
            "piece_ids": lists([r[0].astype(np.int32) for r in rows], pa.int32()),
            "piece_starts": lists([r[1] for r in rows], pa.int64()),
            "piece_ends": lists([r[2] for r in rows], pa.int64()),
        }

    added = [("piece_ids", T.ArrayType(T.IntegerType())), ("piece_starts", T.ArrayType(T.LongType())), ("piece_ends", T.ArrayType(T.LongType()))]
    return arrow_map(docs, per_batch, docs.columns if carry is None else carry, added)


def decode(encoded: DataFrame, model_path: str, ids: str = "piece_ids", carry: list[str] | None = None) -> DataFrame:
    """Add `decoded` (string) to rows of piece ids; null ids give an empty string."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = loaded(shared.value)
        column = batch.column(batch.schema.get_field_index(ids))
        return {"decoded": pa.array([model.decode(x.as_py() or []) for x in column], pa.string())}

    return arrow_map(encoded, per_batch, encoded.columns if carry is None else carry, [("decoded", T.StringType())])


def round_trip(docs: DataFrame, model_path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Encode and decode in one pass, keeping digests: `n_tokens`, `ids_sha256`, `decoded_sha256`, and `span_bytes`,
    the original bytes the spans of all pieces cover. Ids and decoded texts never leave the worker."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = loaded(shared.value)
        n, digests, decoded, covered = [], [], [], []
        for ids, first, last in model.encode_all(list(utf8(batch, text))):
            n.append(len(ids))
            covered.append(int((last - first).sum()))
            digests.append(hashlib.sha256(ids.tobytes()).hexdigest())
            decoded.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        return {
            "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(digests, pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string()), "span_bytes": pa.array(covered, pa.int64()),
        }

    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("span_bytes", T.LongType())]
    return arrow_map(docs, per_batch, docs.columns if carry is None else carry, added)
