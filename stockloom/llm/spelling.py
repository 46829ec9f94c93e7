"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A word is written between two end marks. The gram at a place is the shortest stretch from there, of SHORTEST to
LONGEST characters, that is not frequent among the words, so common beginnings are read further than rare ones.
The frequent grams are the dictionary: it is pruned by frequency, and it is small, since at most TABLE_SIZE
grams of a length can make up more than 1/TABLE_SIZE of all places each. Whether a gram ends is decided by
the gram itself, so an edit affects the grams that cover its place and no others.

That bounds, for every word and every place an edit may take, which grams can differ: all the others stand in the
other word, too, those on the left at the same place, those on the right at the same distance from the end. The
lists of all these grams are merged in one go: a word is entered once per place under a checksum of its unaffected
grams there (one for a changed character, one as the shorter word, one as the longer one), and only words entered
under the same checksum meet. What is unknown of such words are the characters no unaffected gram covers, fewer
than 2 * LONGEST, so a list is short however many words there are. Candidates are verified by their edit distance.

Defined results: null and empty texts have no words; a null id counts as empty text in the checksum. Repeated rows
count as often as they stand there. Ties between forms go to the first in code-point order. Long texts are read
whole. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import ship, stored

# The letters of a word, after A-Z have become a-z.
RUN = "[a-zÀ-ÿ]+"
DAMAGE = 97

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2

#: Lengths of grams. Longer ones leave more of a word unknown around an edit, shorter ones depend less on the words.
SHORTEST, LONGEST = 2, 3
#: A gram is frequent if it makes up more than 1 / TABLE_SIZE of all places, and at least LEAST of them.
TABLE_SIZE, LEAST = 100_000, 20
BEGIN, END = "^", "$"
WORDS_AT_ONCE = 2000


def damaged(run: Column, key: Column) -> Column:
    """The run without one of its characters, if the checksum of `key:run` says so."""
    h = F.crc32(F.concat(key, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % DAMAGE == 0, cut).otherwise(run)


def words_of(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): every word of the texts with its number of occurrences."""
    lower = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.char_length("run") >= MIN_LETTERS)
    words = runs.select(damaged(F.col("run"), F.col("key")).alias("word")).where(F.char_length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The gram dictionary: frequent grams and how many places they have. Its size is bounded by
    TABLE_SIZE per length, whatever the number of words, so it is read here and sent to the tasks."""
    marked = F.concat(F.lit(BEGIN), F.col("word"), F.lit(END))
    places = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    least = max(LEAST, places // TABLE_SIZE)
    of_length = [
        F.transform(F.sequence(F.lit(1), F.char_length(marked) - (q - 1)), lambda i, q=q: F.substring(marked, i, F.lit(q)))
        for q in range(SHORTEST, LONGEST + 1)
    ]
    grams = words.select(F.explode(F.concat(*of_length)).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > least)
    return {r["gram"]: r["n"] for r in counts.toLocalIterator()}


def grams_of(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram at each place of a word."""
    s = BEGIN + word + END
    out = []
    for p in range(len(s) - 1):
        end = p + SHORTEST
        while end < len(s) and end - p < LONGEST and s[p:end] in frequent:
            end += 1
        out.append(s[p:end])
    return out


def unaffected(grams: list[str], hashed: Callable[[str], int]) -> tuple[list[int], list[int]]:
    """Two tables of sums over the places of a word: of the grams that end before a place, each with its place, and of
    those that begin at it or later, each with its distance from the end."""
    n = len(grams) + 1
    ending = [0] * (n + 1)
    for p, gram in enumerate(grams):
        ending[p + len(gram)] += hashed(gram) * (2 * p + 1)
    left = list(accumulate(ending))
    right = [0] * (n + 1)
    for p in range(n - 2, -1, -1):
        right[p] = right[p + 1] + hashed(grams[p]) * (2 * (n - p) + 1)
    return left, right


CHANGED, SHORTER, LONGER = range(3)


def entries(word: str, frequent: dict[str, int], hashed: Callable[[str], int]) -> Iterator[tuple[int, int]]:
    """(kind, checksum) for every place an edit may take in a word; the end marks stay as they are."""
    size = len(word)
    left, right = unaffected(grams_of(word, frequent), hashed)
    for i in range(1, size + 1):
        around = left[i] * FACTORS[0] + right[i + 1] * FACTORS[1]
        yield CHANGED, _signed(around + size * FACTORS[2] + FACTORS[3])
        yield LONGER, _signed(around + (size - 1) * FACTORS[2])
    for gap in range(1, size + 2):
        yield SHORTER, _signed(left[gap] * FACTORS[0] + right[gap] * FACTORS[1] + size * FACTORS[2])


# Odd 64-bit numbers that keep the parts of a checksum apart.
FACTORS = tuple(int.from_bytes(blake2b(bytes([i]), digest_size=8).digest(), "big") | 1 for i in range(4))


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def gram_index(words: DataFrame) -> DataFrame:
    """(word, n, kind, key): every word under the checksums of its unaffected grams, a row per place and kind of edit."""
    shared = words.sparkSession.sparkContext.broadcast(frequent_grams(words))
    schema = T.StructType([
        T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("kind", T.ByteType()),
        T.StructField("key", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value

        @lru_cache(maxsize=200_000)
        def hashed(gram: str) -> int:
            return int.from_bytes(blake2b(gram.encode(), digest_size=8).digest(), "big")

        for batch in batches:
            for start in range(0, batch.num_rows, WORDS_AT_ONCE):
                part = batch.slice(start, WORDS_AT_ONCE)
                kinds, keys, counts = [], [], []
                for word in part.column(0).to_pylist():
                    before = len(keys)
                    for kind, key in entries(word, frequent, hashed):
                        kinds.append(kind)
                        keys.append(key)
                    counts.append(len(keys) - before)
                at = pa.array(np.repeat(np.arange(len(counts)), counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(kinds, pa.int8()), pa.array(keys, pa.int64())], schema.names)

    ship(words.sparkSession)
    return words.select("word", "n").mapInArrow(run, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): pairs of words one edit apart, each once, the shorter or smaller word first."""
    index = stored(gram_index(words), "grams")
    asked = index.where(F.col("kind") != LONGER).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    lists = index.where(F.col("kind") != SHORTER).select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    first = (F.char_length("a") < F.char_length("b")) | ((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))
    close = asked.join(lists, "key").where(first & (F.levenshtein("a", "b", 1) == 1))
    return close.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).distinct()


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last one, twice as far in each round.

    The count at least doubles from a word to its form, so a chain has no more steps than `most`, the
    largest count, can be halved."""
    steps = max(1, int(math.log(max(2, most / MIN_COUNT), RATIO)) + 1)
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        reached = stored(step, "roots")
    return reached


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n): each frequent word, the more frequent word it is a variant of, and the last
    one in that row of variants."""
    words = stored(words_of(docs, text, key), "words")
    pairs = stored(near_pairs(words), "near")
    both = pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    likely = -F.col("best.less") >= RATIO * F.col("n")
    formed = stored(best.select(
        "word", "n_near", F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.less")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    last = roots(formed.where(F.col("form").isNotNull()), most)
    return words.join(formed, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
