"""Near-duplicates by SimHash fingerprints and pigeonhole blocks.

A fingerprint is cut into `distance + 2` blocks. Two fingerprints that differ in at most `distance` bits
agree on at least two whole blocks, so they meet under one of the pairs of blocks; pairs that meet are
compared bit by bit. Two blocks instead of one make the keys some 26 bits wide, so that unlike
fingerprints seldom meet.

Equal fingerprints are one node from the start, so a group of copies of any size costs one node. A key
under which very many different fingerprints meet is cut into parts, and pairs of parts go to tasks of
their own. A task returns the links of one key as stars (member to smallest member), never as all pairs.

Defined results: a null text is empty; texts without words have fingerprint zero and link like any other.
A row is linked by its fingerprint, also if it has no id or an id that other rows have, too; the component
is the smallest id among its rows, null if none has one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import arrow_map, ascii_lower, col, partitions, ship, stored, utf8, words_of
from stockloom.llm.components import components

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints of one key that are compared in one piece. A larger group is cut, not capped.
PART = 2048
#: Shingles hashed at a time.
STRETCH = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of the word shingles, repeats included."""
    words = words_of(ascii_lower(text))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, STRETCH):
        hashes = np.array([digest(joined[x:y], SEED) for x, y in zip(firsts[i : i + STRETCH], lasts[i : i + STRETCH])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", carry: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """Add `fingerprint` (the 64 bits as a signed long) to each document."""

    def per_batch(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = np.array([fingerprint(t, shingle) for t in utf8(batch, text)], dtype=np.uint64)
        return {"fingerprint": pa.array(found.view(np.int64))}

    return arrow_map(docs, per_batch, docs.columns if carry is None else carry, [("fingerprint", T.LongType())])


def block_masks(distance: int) -> list[int]:
    """For each pair of blocks, the bits of both."""
    blocks = distance + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    of_block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [x | y for x, y in combinations(of_block, 2)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _stars(near: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smallest label each row reaches within a matrix of links."""
    while True:
        least = np.where(near, labels[None, :], labels.max()).min(axis=1)
        least = np.minimum(least, labels)
        if (least == labels).all():
            return labels
        labels = least


def _group_links(nodes: np.ndarray, parts: np.ndarray, first: int, second: int, distance: int):
    """Links (node, smaller node) inside a part, or between two parts, of one key."""
    prints = nodes.view(np.uint64)
    if first == second:
        rows, columns = np.arange(len(nodes)), np.arange(len(nodes))
    else:
        rows, columns = np.flatnonzero(parts == first), np.flatnonzero(parts == second)
    near = np.zeros((len(nodes), len(nodes)), dtype=bool)
    for i in range(0, len(rows), 256):
        r = rows[i : i + 256]
        near[np.ix_(r, columns)] = np.bitwise_count(prints[r][:, None] ^ prints[columns][None, :]) <= distance
    near |= near.T
    reached = _stars(near, nodes)
    linked = reached != nodes
    return nodes[linked], reached[linked]


def link_groups(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (key, first, second) to links. A group is at most two parts."""
    rest: pa.Table | None = None

    def links(table: pa.Table) -> pa.RecordBatch:
        keys = np.stack([table[c].to_numpy() for c in ("pair", "key", "first", "second")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [table.num_rows]))
        nodes, parts = table["fingerprint"].to_numpy(), table["part"].to_numpy()
        out = []
        for s, e in zip(starts, ends):
            if e - s > 1:
                out.append(_group_links(nodes[s:e], parts[s:e], keys[2, s], keys[3, s], distance))
        a = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
        b = np.concatenate([y for _, y in out]) if out else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        last = [table[c][-1].as_py() for c in ("pair", "key", "first", "second")]
        keys = [table[c].to_numpy() for c in ("pair", "key", "first", "second")]
        others = np.flatnonzero(np.any([k != v for k, v in zip(keys, last)], axis=0))
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield links(table.slice(0, cut))
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield links(rest)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (`a`, `b`) between different fingerprints that connect all those at most `distance` bits apart.

    They span the same components as all such pairs would.
    """
    masks = [F.struct(F.lit(i).alias("pair"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(block_masks(distance))]
    keyed = prints.select("fingerprint", F.explode(F.array(*masks)).alias("k")).select("fingerprint", "k.pair", "k.key")
    sizes = keyed.groupBy("pair", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = keyed.join(sizes, ["pair", "key"]).withColumn("parts", F.ceil(F.col("size") / PART).cast("int"))
    met = met.withColumn("part", F.expr("cast(pmod(xxhash64(fingerprint), parts) as int)"))
    # Part i of a cut key meets every part j in the task of (min, max).
    met = met.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    met = met.select("pair", "key", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "fingerprint")
    n = partitions(prints.sparkSession)
    ship(prints.sparkSession)
    dealt = met.repartition(n, "pair", "key", "first", "second").sortWithinPartitions("pair", "key", "first", "second")
    return dealt.mapInArrow(lambda b: link_groups(b, distance), "a long, b long")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """Rows (id, `fingerprint` as 16 hex digits, `component_id`), one per document.

    `component_id` is the smallest id reachable over links, the document's own included.
    """
    prints, classes = _classes(docs, id, text, shingle, distance)
    return prints.join(classes, "fingerprint").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(docs: DataFrame, id: str, text: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(`id`, `fingerprint`) per document, and (`fingerprint`, `component`, `component_id`) per fingerprint."""
    narrow = docs.select(col(id).cast("long").alias("id"), col(text).alias("text"))
    prints = stored(fingerprints(narrow, "text", ["id"], shingle), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("least_id")), "nodes")
    found = components(links(nodes.select("fingerprint"), distance)).withColumnRenamed("node", "fingerprint")
    placed = nodes.join(found, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    placed = stored(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return prints, placed.join(least, "component").select("fingerprint", "component", "component_id")


def first_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents, one of each group of near-duplicates: the one with the smallest id.

    Of rows of a group that repeat that id, and of the rows of a group in which none has an id, one stays. Only
    ids and fingerprints are grouped; the texts are moved once, to meet the ids that stay. Rows whose id is
    null or repeated are told apart by their fingerprints, taken once more.
    """
    prints, classes = _classes(docs, id, text, shingle, distance)
    classes = stored(classes, "classes")
    met = prints.join(classes, "fingerprint")
    first = F.max((F.col("id") == F.col("component_id")).cast("int"))
    ids = stored(met.groupBy("id").agg(F.count(F.lit(1)).alias("n"), first.alias("first")), "ids")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no clash with the columns used here
    rows, own = docs.withColumnsRenamed(names), list(names.values())
    row_id = F.col(names[id]).cast("long")
    # The ids that stay are a fixed share of the rows, so this is a join of two large sides; it is planned as
    # one at every size, also where the ids would still fit a broadcast.
    out = rows.join(ids.filter("n = 1 and first = 1").hint("merge"), row_id == F.col("id")).select(*own)
    unclear = ids.filter("n > 1 or id is null")
    if not unclear.isEmpty():
        again = rows.join(unclear.select("id"), row_id.eqNullSafe(F.col("id")), "left_semi")
        again = fingerprints(again, names[text], shingle=shingle).join(classes, "fingerprint")
        again = again.filter(row_id.eqNullSafe(F.col("component_id")))
        one = F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row")
        out = out.unionByName(again.groupBy("component").agg(one).select("row.*"))
    return out.withColumnsRenamed({v: k for k, v in names.items()})
