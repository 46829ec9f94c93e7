"""Fingerprints, links and components against all pairs."""

import random

import pytest
import xxhash

from stockloom.llm import simhash
from stockloom.llm.components import components


def plain_print(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, distance=3):
    """The group of each row, and the smallest id of each group."""
    prints = [plain_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[root(i)] = root(j)
    least = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            least[root(i)] = min(id, least.get(root(i), id))
    return prints, [root(i) for i in range(len(rows))], least


def plain_components(rows):
    prints, group, least = plain_groups(rows)
    return sorted((id is None, id or 0, f"{prints[i]:016x}", str(least.get(group[i]))) for i, (id, _) in enumerate(rows))


def plain_survivors(rows):
    _, group, least = plain_groups(rows)
    return sorted(str(least.get(g)) for g in set(group))


def samples():
    pick = random.Random(4)
    vocabulary = ["w%d" % i for i in range(300)]
    rows = [(900, None), (901, ""), (902, " \n "), (903, "Only two"), (903, "only TWO"), (None, "only two"), (None, None), (904, "a b c")]
    for g in range(25):
        words = [pick.choice(vocabulary) for _ in range(pick.choice([5, 80, 400]))]
        for _ in range(pick.randint(1, 8)):
            changed = [w if pick.random() > 0.01 else pick.choice(vocabulary) for w in words]
            rows.append((pick.randint(0, 800), " ".join(changed)))
    return rows + rows[10:14]


def result(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], str(r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("part", [2048, 2])
def test_equals_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rows = samples()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fingerprint", "2 AS component", "3 AS n")
    assert result(simhash.near_duplicates(docs)) == plain_components(rows)


def test_links_over_bits_next_to_block_borders(spark):
    """Every pair at most three bits apart meets, wherever the bits are."""
    pick = random.Random(8)
    prints = [pick.getrandbits(64) for _ in range(150)]
    near = []
    for p in prints:
        q = p
        for bit in pick.sample(range(64), pick.randint(1, 5)):
            q ^= 1 << bit
        near.append(q)
    every = sorted({p - (1 << 64) if p >> 63 else p for p in prints + near})
    found = components(simhash.links(spark.createDataFrame([(p,) for p in every], "fingerprint long")))
    together = {r["node"]: r["component"] for r in found.collect()}
    for p, q in zip(prints, near):
        p, q = (x - (1 << 64) if x >> 63 else x for x in (p, q))
        assert (together.get(p, p) == together.get(q, q)) == (((p ^ q) & (2**64 - 1)).bit_count() <= 3)


def test_first_of_each_group(spark):
    rows = samples()
    docs = spark.createDataFrame([(i, t, "en", "n") for i, t in rows], "doc_id long, text string, lang string, n string")
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(str(r["doc_id"]) for r in got) == plain_survivors(rows)
    assert {(r["doc_id"], r["text"]) for r in got} <= set(rows)


def test_groups_without_ids_keep_one_row(spark):
    docs = spark.createDataFrame([(None, "some words that repeat"), (None, "some words that repeat"), (1, "others here now")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in simhash.first_of_each(docs).collect()) == ["1", "None"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.first_of_each(docs).count() == 0


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 501), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert {found[n] for n in order} == {0} and found[501] == found[500] == 500
