"""Language-model scores by context-tree weighting over bytes.

A text is read as its words in lower case (A-Z), one blank between them and a line feed as the end, so every
sequence of words is exactly one byte string. Each byte is eight binary decisions; a decision is seen at the
place (bits of the byte so far) in the context of the 0, 1, … up to `depth` bytes before it. A node of the
context tree counts the zeros and ones seen there in training and estimates the next bit by
Krichevsky-Trofimov, (n + 1/2) / (n0 + n1 + 1). The weighted probability of what a node saw,

    Pw = 1/2 Pkt + 1/2 product of Pw of its children (at the largest depth Pw = Pkt),

mixes all depths, and the share of the first summand is the node's posterior weight: the prediction for a bit
is, from the deepest node of the context that training saw up to the root,

    eta = weight * kt + (1 - weight) * eta of the deeper node.

A context training never saw ends the path, which depends on the context alone, so the predictions of a bit
still add up to one. The score is the log10 of the probability of the whole text, its end included.

Counting and scoring go through runs and buckets (`exchange`): a run sends its different grams (context and
byte) with training counts; a bucket, all grams with the same two last bytes of context, has whole subtrees
and sends back the log10 probability of each gram. Only nodes of depth 0 and 1, at most 65,535 whatever the
corpus, are summed up on the driver. The words of the base score travel the same way. The gathered counts grow
with the text; nothing is sampled or hashed together.

Defined results: a null text is empty, i.e. an end only. A null id counts as the empty string, whose
remainder is 0, so it is held out. Repeated rows train and are scored each for itself. Without training texts
every bit has probability 1/2. An empty table gives no rows. Texts are read whole; extra columns are not used.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm import exchange
from stockloom.llm.common import ascii_lower, partitions, stored, words_of

DEPTH = 5
END = b"\n"
HELD_OUT = 10
#: Runs per partition: a task holds the words and grams of one run at a time.
RUNS_PER_PARTITION = 2
#: Bytes whose grams are sorted at a time.
STRETCH = 1 << 20
WORDS = ["words", "word_counts"]
GRAMS = ["grams", "gram_counts"]
LOG_HALF = float(np.log(0.5))


def held_out(id: int | None) -> bool:
    """Whether training leaves the document out."""
    return zlib.crc32(b"" if id is None else str(id).encode()) % HELD_OUT == 0


def encoded(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def grams_of(data: bytes, depth: int) -> np.ndarray:
    """For each byte of a text: its context, last byte first, and the byte, as one number. What stands before
    a text is taken to be ends of texts."""
    x = np.frombuffer(END * depth + data, np.uint8).astype(np.uint64)
    n = len(data)
    out = x[depth:].copy()
    for back in range(1, depth + 1):
        out |= x[depth - back : depth - back + n] << np.uint64(8 * (depth - back + 1))
    return out


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series from x + 8 on."""
    below = np.log(x)
    for i in range(1, 8):
        below = below + np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - below


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability the estimator gives, in all, to that many zeros and ones, in any order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """The nodes of one depth at one bit place: sorted keys (context, bits so far), counts and weights."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        kt = log_kt(zeros, ones)
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.log_weighted = kt if below is None else np.logaddexp(kt, below) + LOG_HALF
        self.weight = np.ones(len(keys)) if below is None else np.exp(kt + LOG_HALF - self.log_weighted)

    def mix(self, keys: np.ndarray, bits: np.ndarray, eta: np.ndarray, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predictions of the bits at the nodes of these keys, given those of the deeper nodes where there are any."""
        if not len(self.keys):
            return eta, deeper
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        here = self.keys[at] == keys
        seen = np.where(bits, self.ones[at], self.zeros[at])
        p = (seen + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)
        w = np.where(deeper, self.weight[at], 1.0)
        return np.where(here, w * p + (1 - w) * eta, eta), deeper | here


def _place(symbols: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of the bytes before place j, led by a one, and the bit at that place."""
    symbols = symbols.astype(np.uint64)
    return np.uint64(1 << j) | (symbols >> np.uint64(8 - j)), (symbols >> np.uint64(7 - j)) & np.uint64(1)


def _group(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the values over equal neighbours of sorted keys."""
    if not len(keys):
        return (keys, *values)
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return (keys[starts], *[np.add.reduceat(v, starts) for v in values])


def subtree(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[tuple[int, int], Level]:
    """The levels (depth, bit place) from `depth` up to `top` of the given sorted grams."""
    levels: dict[tuple[int, int], Level] = {}
    grams, counts = grams[counts > 0], counts[counts > 0].astype(float)
    for d in range(depth, top - 1, -1):
        contexts, symbols = grams >> np.uint64(8), grams & np.uint64(255)
        for j in range(8):
            bits_before, bit = _place(symbols, j)
            keys, total, ones = _group((contexts << np.uint64(8)) | bits_before, counts, counts * bit)
            below = None
            if d < depth:
                child = levels[d + 1, j]
                parents = ((child.keys >> np.uint64(16)) << np.uint64(8)) | (child.keys & np.uint64(255))
                below = np.bincount(np.searchsorted(keys, parents), weights=child.log_weighted, minlength=len(keys))
            levels[d, j] = Level(keys, total - ones, ones, below)
        if d > top:
            shorter = ((contexts >> np.uint64(8)) << np.uint64(8)) | symbols
            grams, where = np.unique(shorter, return_inverse=True)
            counts = np.bincount(where, weights=counts, minlength=len(grams))
    return levels


def score_grams(grams: np.ndarray, levels: dict[tuple[int, int], Level], depth: int) -> np.ndarray:
    """Log10 of the probability of the byte of each gram in its context."""
    out = np.zeros(len(grams))
    symbols = grams & np.uint64(255)
    for j in range(8):
        bits_before, bit = _place(symbols, j)
        eta, deeper = np.full(len(grams), 0.5), np.zeros(len(grams), dtype=bool)
        for d in range(depth, -1, -1):
            level = levels.get((d, j))
            if level is not None:
                context = grams >> np.uint64(8 * (depth - d + 1))
                eta, deeper = level.mix((context << np.uint64(8)) | bits_before, bit == 1, eta, deeper)
        out += np.log10(eta)
    return out


def _bucket_of_word(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def _bucket_of_gram(grams: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    """By the last two bytes of the context, mixed so that neighbours spread."""
    pair = grams >> np.uint64(8 * (depth - 1))
    return ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)


def _stretches(table: pa.Table) -> Iterator[list[tuple[int, bool, list[bytes]]]]:
    """The documents of a run, some at a time: (row, held out, words)."""
    part, size = [], 0
    for i, (id, text) in enumerate(zip(table["id"].to_pylist(), exchange.texts(table))):
        words = words_of(ascii_lower(text))
        part.append((i, held_out(id), words))
        size += len(text)
        if size >= STRETCH:
            yield part
            part, size = [], 0
    if part:
        yield part


def _run_words(words: Iterable[bytes], buckets: int) -> dict[int, list[bytes]]:
    """The different words of a run by bucket, in order."""
    by_bucket: dict[int, list[bytes]] = {}
    for word in words:
        by_bucket.setdefault(_bucket_of_word(word, buckets), []).append(word)
    for words in by_bucket.values():
        words.sort()
    return by_bucket


def _grams_of_run(parts: list[np.ndarray]) -> np.ndarray:
    """All different grams of the parts, in order."""
    if not parts:
        return np.zeros(0, np.uint64)
    every = np.sort(np.concatenate(parts))
    return every[np.concatenate(([True], every[1:] != every[:-1]))]


def _collect(depth: int, buckets: int):
    def collect(table: pa.Table) -> Iterator[tuple[int, exchange.Arrays]]:
        seen: Counter = Counter()
        trained: Counter = Counter()
        grams, times = [], []
        for part in _stretches(table):
            for _, held, words in part:
                (seen if held else trained).update(words)
                (seen if held else trained)[END] += 1
            for learned in (False, True):
                data = [grams_of(encoded(words), depth) for _, held, words in part if held != learned]
                if data:
                    values, n = np.unique(np.concatenate(data), return_counts=True)
                    grams.append(values)
                    times.append(n if learned else np.zeros(len(n), np.int64))
        every = _grams_of_run(grams)
        counts = np.zeros(len(every), np.int64)
        for values, n in zip(grams, times):
            counts[np.searchsorted(every, values)] += n
        for word in trained:
            seen[word] += 0
        words = _run_words(seen, buckets)
        place = _bucket_of_gram(every, depth, buckets)
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(buckets), side="right")
        start = 0
        for b in range(buckets):
            mine = order[start : ends[b]]
            start = ends[b]
            listed = words.get(b, [])
            if len(mine) or listed:
                yield b, {
                    "words": b" ".join(listed),
                    "word_counts": np.fromiter((trained.get(w, 0) for w in listed), np.int64, len(listed)).tobytes(),
                    "grams": _planes(every[mine]),
                    "gram_counts": counts[mine].astype("<i4").tobytes(),
                }

    return collect


def _planes(values: np.ndarray) -> bytes:
    """Sorted numbers byte by byte, high bytes first: long runs of equal bytes, which the shuffle compresses."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").reshape(-1).astype(np.uint64)


def _split_words(data: bytes) -> list[bytes]:
    # The end token is white space, so it is kept apart from the blanks between words.
    return data.split(b" ") if data else []


def _merged_grams(arrays: list[exchange.Arrays]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The grams of each run, all different grams, and their training counts."""
    per_run = [_from_planes(a["grams"]) for a in arrays]
    every = _grams_of_run(per_run)
    counts = np.zeros(len(every))
    for values, a in zip(per_run, arrays):
        counts[np.searchsorted(every, values)] += np.frombuffer(a["gram_counts"], "<i4")
    return per_run, every, counts


TOP = 2


def _roots(asked: DataFrame, depth: int) -> DataFrame:
    """Per node of depth 1 (last byte, bits so far): counts, and log Pw of its children together."""

    def settle(table: pa.Table) -> pa.Table:
        arrays = [{"grams": g, "gram_counts": c} for g, c in zip(table["grams"].to_pylist(), table["gram_counts"].to_pylist())]
        _, every, counts = _merged_grams(arrays)
        levels = subtree(every, counts, depth, TOP)
        nodes = [levels[TOP, j] for j in range(8)]
        keys = np.concatenate([n.keys for n in nodes])
        parents = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
        named, where = np.unique(parents, return_inverse=True)

        def total(values: list[np.ndarray]) -> np.ndarray:
            return np.bincount(where, weights=np.concatenate(values), minlength=len(named)).astype(float)

        return pa.table({
            "node": pa.array(named.astype(np.int64)),
            "zeros": pa.array(total([n.zeros for n in nodes])),
            "ones": pa.array(total([n.ones for n in nodes])),
            "below": pa.array(total([n.log_weighted for n in nodes])),
        })

    found = asked.select("bucket", *GRAMS).groupBy("bucket").applyInArrow(settle, "node long, zeros double, ones double, below double")
    return found.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))


def _upper_levels(rows: list) -> dict[tuple[int, int], Level]:
    """Depths 1 and 0 from the sums of all buckets."""
    rows = sorted(rows, key=lambda r: r["node"])
    keys = np.array([r["node"] for r in rows], np.uint64)
    zeros, ones, below = (np.array([r[c] for r in rows], float) for c in ("zeros", "ones", "below"))
    place = np.floor(np.log2(np.maximum((keys & np.uint64(255)).astype(float), 1))).astype(int)
    levels = {}
    for j in range(8):
        at = np.flatnonzero(place == j)
        one = Level(keys[at], zeros[at], ones[at], below[at])
        roots, where = np.unique(one.keys & np.uint64(255), return_inverse=True)
        sums = [np.bincount(where, weights=v, minlength=len(roots)) for v in (one.zeros, one.ones, one.log_weighted)]
        levels[1, j], levels[0, j] = one, Level(roots, *sums)
    return levels


def score(docs: DataFrame, id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Per document: id, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score` (word frequencies),
    `score` (the context tree), `n_bytes` and `bits_per_byte` of the text as the model reads it."""
    if not TOP <= depth <= 7:
        raise ValueError("depth must be 2 to 7")
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = exchange.dealt(docs, id, text, RUNS_PER_PARTITION * buckets)
    asked = stored(exchange.ask(rows, _collect(depth, buckets), WORDS + GRAMS), "counts")
    upper = spark.sparkContext.broadcast(_upper_levels(_roots(asked, depth).collect()))  # at most 65,280 rows

    def settle(bucket: int, runs: list[int], arrays: list[exchange.Arrays]) -> Iterator[exchange.Arrays]:
        total: Counter = Counter()
        lists = [_split_words(a["words"]) for a in arrays]
        for words, a in zip(lists, arrays):
            for word, n in zip(words, np.frombuffer(a["word_counts"], np.int64).tolist()):
                total[word] += n
        per_run, every, counts = _merged_grams(arrays)
        found = score_grams(every, subtree(every, counts, depth, TOP) | upper.value, depth)
        totals = np.array([sum(total.values()), sum(1 for n in total.values() if n)], np.int64).tobytes()
        for words, grams in zip(lists, per_run):
            yield {
                "known": np.fromiter((total[w] for w in words), np.int64, len(words)).tobytes(),
                "logs": found[np.searchsorted(every, grams)].tobytes(),
                "totals": totals,
            }

    back = ["known", "logs", "totals"]
    answers = stored(exchange.answer(asked, settle, WORDS + GRAMS, back), "answers")
    sums = answers.select("bucket", "totals").groupBy("bucket").agg(F.first("totals").alias("totals")).collect()
    pairs = [np.frombuffer(r["totals"], np.int64) for r in sums]  # one pair per bucket
    train_tokens, vocabulary = (int(sum(p[i] for p in pairs)) for i in (0, 1))
    floor = float(np.log10(train_tokens + 0.1 * (vocabulary + 1)))

    def use(table: pa.Table, replies: dict[int, exchange.Arrays]) -> pa.Table:
        columns: dict[str, list] = {c: [None] * table.num_rows for c in ("held", "n_tokens", "n_known", "base", "score", "n_bytes")}
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__  # each new word gets the next number
        end, parts = numbers[END], []
        for part in _stretches(table):
            data = [encoded(ws) for _, _, ws in part]
            values, where = np.unique(np.concatenate([grams_of(d, depth) for d in data]), return_inverse=True)
            tokens = [np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)) for _, _, ws in part]
            rows = [(i, held, len(d)) for (i, held, _), d in zip(part, data)]
            parts.append((rows, tokens, values, where.astype(np.int32)))
        known = np.zeros(len(numbers))
        for b, listed in _run_words(numbers, buckets).items():
            known[[numbers[w] for w in listed]] = np.frombuffer(replies[b]["known"], np.int64)
        every = _grams_of_run([values for _, _, values, _ in parts])
        place = _bucket_of_gram(every, depth, buckets)
        logs = np.empty(len(every))
        for b in np.unique(place).tolist():
            logs[place == b] = np.frombuffer(replies[b]["logs"], float)
        base = np.log10(known + 0.1)
        for rows, tokens, values, where in parts:
            each = logs[np.searchsorted(every, values)][where]
            start = 0
            for (i, held, size), ids in zip(rows, tokens):
                columns["held"][i], columns["n_tokens"][i], columns["n_bytes"][i] = held, len(ids) + 1, size
                columns["n_known"][i] = int((known[ids] > 0).sum() + (known[end] > 0))
                columns["base"][i] = float(base[ids].sum() + base[end] - (len(ids) + 1) * floor)
                columns["score"][i] = float(each[start : start + size].sum())
                start += size
        bits = [-s / np.log10(2) / n for s, n in zip(columns["score"], columns["n_bytes"])]
        return pa.table({
            "id": table["id"], "held_out": pa.array(columns["held"], pa.bool_()),
            "n_tokens": pa.array(columns["n_tokens"], pa.int64()), "n_known": pa.array(columns["n_known"], pa.int64()),
            "train_tokens": pa.array([train_tokens] * table.num_rows, pa.int64()),
            "base_score": pa.array(columns["base"], pa.float64()), "score": pa.array(columns["score"], pa.float64()),
            "n_bytes": pa.array(columns["n_bytes"], pa.int64()), "bits_per_byte": pa.array(bits, pa.float64()),
        })

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return exchange.resolve(rows, answers, use, back, schema).withColumnRenamed("id", id)
