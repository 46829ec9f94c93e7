"""Byte-pair encoding and decoding by an automaton over tokens.

The merges are compiled one after another. The automaton starts with one state in which every byte may
follow and which every byte leads to; the gadget of a merge (u, v) -> uv then

* gives u a state of its own, a copy of the one it led to if other tokens lead there, too, and takes out the
  arc for v: u and v no longer stand side by side;
* adds an arc for uv, to the state v led to, wherever u can follow.

A merge whose halves no path has side by side changes nothing. After the last merge a word has exactly one
path whose labels spell it, and that path is its encoding.

The state after a token depends on that token alone, and tokens share a state as long as no gadget tells them
apart, so the states are a list of one entry per token and the arcs a table of one bit per state and token
(14,639 states and 92 MB for 50,000 merges). It is built once, on the driver, and sent to the workers
compressed; its size depends on the vocabulary, never on the corpus.

Encoding goes once through a word, from the left. A place between two bytes is entered by the one token that
ends the encoding of what stands before it; from its state, the tokens that begin there and whose bit is set
enter the places where they end. Nothing is tried twice or taken back. Decoding emits the labels.

Defined results: a null text is empty and has no tokens. Texts are encoded whole. Special tokens that stand
in a text become their ids. Repeated rows are encoded one by one; input columns pass through unless a
result has their name; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockloom.llm.common import arrow_map, utf8

# The pattern that cuts texts into words before the merges.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Encoded words a worker keeps at most; beyond that it starts over.
KEPT_WORDS = 400_000
START = 0


def byte_letters() -> dict[str, int]:
    """The letter each byte is written as in a vocabulary file: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Automaton:
    """The compiled merges of one vocabulary."""

    def __init__(self, vocabulary: str):
        data = json.loads(vocabulary)
        letters = byte_letters()
        ids: dict[str, int] = data["model"]["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.labels = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.labels[i] = bytes(letters[c] for c in token)
        for content, i in self.special.items():
            self.labels[i] = content.encode()
        #: The state each token leads to, -1 for tokens no path has.
        self.leads_to = np.full(len(self.labels), -1, np.int32)
        #: Bit `token % 8` of row `token // 8` and column `state`: whether the state has an arc for the token.
        self.table = np.zeros(((len(self.labels) + 7) // 8, 64), np.uint8)
        self.shared = [1]  # the start counts as leading to its state
        for token, i in ids.items():
            if len(token) == 1:
                self.leads_to[i] = START
                self.shared[START] += 1
                self.table[i >> 3, START] |= 1 << (i & 7)
        for merge in data["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.gadget(ids[a], ids[b], ids[a + b])
        self.table = np.ascontiguousarray(self.table[:, : len(self.shared)])
        self.prepare()

    def gadget(self, u: int, v: int, uv: int) -> None:
        """Work one merge into the automaton."""
        state, target = int(self.leads_to[u]), int(self.leads_to[v])
        if state < 0 or target < 0 or not self.table[v >> 3, state] >> (v & 7) & 1:
            return
        if self.shared[state] > 1 or u == v:  # uu will lead to the state as it was
            self.shared[state] -= 1
            state = self.leads_to[u] = self.copy(state)
        self.table[v >> 3, state] &= 255 ^ (1 << (v & 7))
        if self.leads_to[uv] < 0:
            self.leads_to[uv] = target
            self.shared[target] += 1
            can_follow = self.table[u >> 3] >> (u & 7) & 1
            self.table[uv >> 3] |= can_follow << (uv & 7)

    def copy(self, state: int) -> int:
        """A new state with the same arcs."""
        new = len(self.shared)
        if new == self.table.shape[1]:
            self.table = np.hstack([self.table, np.zeros_like(self.table)])
        self.table[:, new] = self.table[:, state]
        self.shared.append(1)
        return new

    def prepare(self) -> None:
        """What encoding looks things up in, all of it following from labels, states and table."""
        self.states = self.leads_to.tolist()
        self.bits = memoryview(self.table).cast("B")
        self.width = self.table.shape[1]
        self.token = {self.labels[i]: i for i in np.flatnonzero(self.leads_to >= 0).tolist()}
        # Labels as a tree: a byte leads from a node to a node, 256 to the token that ends there.
        self.root: dict = {}
        for label, i in self.token.items():
            node = self.root
            for byte in label:
                node = node.setdefault(byte, {})
            node[256] = (i, (i >> 3) * self.width, 1 << (i & 7))
        self.kept: dict[str, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.labels))]
        self.cut = regex.compile(WORD_PATTERN).findall
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def __getstate__(self) -> tuple:
        return self.special, self.labels, self.leads_to, self.table.shape, zlib.compress(self.table, 1)

    def __setstate__(self, state: tuple) -> None:
        self.special, self.labels, self.leads_to, shape, table = state
        self.table = np.frombuffer(zlib.decompress(table), np.uint8).reshape(shape)
        self.prepare()

    def has_arc(self, state: int, token: int) -> bool:
        return bool(self.bits[(token >> 3) * self.width + state] >> (token & 7) & 1)

    def arc(self, before: int, after: int) -> bool:
        """Whether the state of token `before` has an arc labelled `after`."""
        return self.has_arc(self.states[before], after)

    def encode_word(self, word: bytes) -> list[int]:
        """The labels of the one path that spells the word."""
        whole = self.token.get(word)
        if whole is not None:
            return [whole]  # its own encoding, or no path would have it
        root, bits, states, length = self.root, self.bits, self.states, len(word)
        entered = [-1] * (length + 1)  # per place, the token that ends there
        state = START
        for at in range(length):
            if at:
                if entered[at] < 0:
                    raise ValueError(f"the vocabulary cannot spell {word!r}")
                state = states[entered[at]]
            node = root
            for end in range(at, length):
                node = node.get(word[end])
                if node is None:
                    break
                if entered[end + 1] < 0 and 256 in node:  # a place is entered once
                    token, row, bit = node[256]
                    if bits[row + state] & bit:
                        entered[end + 1] = token
        path, at = [], len(word)
        while at:
            path.append(entered[at])
            at -= len(self.labels[entered[at]])
        return path[::-1]

    def encode_words(self, words: list[str]) -> bytes:
        kept = self.kept
        missing = set(words).difference(kept)
        if missing:
            if len(kept) + len(missing) > KEPT_WORDS:
                kept.clear()
                missing = set(words)
            packed = self.packed
            for w in missing:
                kept[w] = b"".join([packed[t] for t in self.encode_word(w.encode())])
        return b"".join([kept[w] for w in words])

    def encode(self, text: str) -> bytes:
        """The ids of a text, each as four little-endian bytes."""
        if self.cut_special is None or not self.cut_special.search(text):
            return self.encode_words(self.cut(text))
        parts = self.cut_special.split(text)
        return b"".join(
            self.packed[self.special[p]] if i % 2 else self.encode_words(self.cut(p)) for i, p in enumerate(parts)
        )

    def decode(self, ids: list[int]) -> str:
        """Emit the labels of the arcs. Bytes that are no UTF-8 become replacement characters."""
        labels = self.labels
        return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read on the driver; a few MB whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return f.read()


@lru_cache(maxsize=2)
def compiled(vocabulary: str) -> Automaton:
    """Compiled once per driver and vocabulary."""
    return Automaton(vocabulary)


def sent(spark: SparkSession, vocabulary_path: str) -> Broadcast[Automaton]:
    """The automaton of a vocabulary file, for all workers."""
    return spark.sparkContext.broadcast(compiled(read_vocabulary(vocabulary_path)))


def tokens(packed: bytes) -> list[int]:
    return memoryview(packed).cast("I").tolist()


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add `token_ids` (array of int) to each document. `carry`: columns to keep, all by default."""
    shared = sent(docs.sparkSession, vocabulary_path)

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = shared.value
        packed = [automaton.encode(t.decode()) for t in utf8(batch, text)]
        offsets = [0]
        for p in packed:
            offsets.append(offsets[-1] + len(p) // 4)
        values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(packed))])
        return {"token_ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)}

    return arrow_map(docs, per_batch, docs.columns if carry is None else carry, [("token_ids", T.ArrayType(T.IntegerType()))])


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "token_ids", carry: list[str] | None = None) -> DataFrame:
    """Add `decoded` (string) to rows of token ids; null ids give an empty string."""
    shared = sent(encoded.sparkSession, vocabulary_path)

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = shared.value
        lists = batch.column(batch.schema.get_field_index(ids))
        return {"decoded": pa.array([automaton.decode(x.as_py() or []) for x in lists], pa.string())}

    return arrow_map(encoded, per_batch, encoded.columns if carry is None else carry, [("decoded", T.StringType())])


def round_trip(docs: DataFrame, vocabulary_path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Encode and decode in one pass, keeping digests: `n_tokens`, `ids_sha256`, `decoded_sha256` and
    `n_bytes` of the text. Ids and decoded texts never leave the worker, so nothing wide is written."""
    shared = sent(docs.sparkSession, vocabulary_path)

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = shared.value
        n, digests, decoded, sizes = [], [], [], []
        for t in utf8(batch, text):
            packed = automaton.encode(t.decode())
            n.append(len(packed) // 4)
            sizes.append(len(t))
            digests.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(automaton.decode(tokens(packed)).encode()).hexdigest())
        return {
            "n_tokens": pa.array(n, pa.int64()),
            "ids_sha256": pa.array(digests, pa.string()),
            "decoded_sha256": pa.array(decoded, pa.string()),
            "n_bytes": pa.array(sizes, pa.int64()),
        }

    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("n_bytes", T.LongType())]
    return arrow_map(docs, per_batch, docs.columns if carry is None else carry, added)
