import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import graph, simhash


def brute_fingerprint(text):
    words = [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """pairs of (id, fingerprint): the smallest id reachable from each."""
    smallest = [i for i, _ in pairs]
    changed = True
    while changed:
        changed = False
        for x, (_, f) in enumerate(pairs):
            for y, (_, g) in enumerate(pairs):
                if (f ^ g).bit_count() <= 4 and smallest[y] < smallest[x]:
                    smallest[x], changed = smallest[y], True
    return smallest


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="aAbÉé \n\t\x0b\x85 ", max_size=60))
def test_fingerprint_equals_the_definition(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("total", [0, 100_000])
@pytest.mark.parametrize("leaf", [1, 4, 1000])
def test_forest_puts_every_linked_pair_into_one_shard(leaf, total):
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base] + [base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, 4, replace=False))) for _ in range(8)])
    forest = simhash.Forest(fps[::2], 5, 4, leaf, total)
    rows, shards = forest.route(fps)
    homes = [set(shards[rows == i].tolist()) for i in range(len(fps))]
    for x in range(len(fps)):
        for y in range(x):
            if int(fps[x] ^ fps[y]).bit_count() <= 4:
                assert homes[x] & homes[y]


@pytest.mark.parametrize("block", [2, 8192])
def test_components_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    texts = []
    for _ in range(25):
        words = list(rng.choice(vocabulary, 60))
        texts.append(" ".join(words))
        for _ in range(2):
            words[int(rng.integers(60))] = "changed"
            texts.append(" ".join(words))
    texts += ["", None, "  \n", "one two", "ONE two", "x" * 100_000, "word " * 30_000]
    rows = [(100 - i, t, "extra") for i, t in enumerate(texts)] + [(100, texts[0], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs, sample=20, leaf=2, block=block).collect()
    pairs = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    want = sorted((i, f, c) for (i, f), c in zip(pairs, brute_components(pairs)))
    assert sorted((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    kept = simhash.keep_first(docs, sample=20, leaf=2, block=block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})


def test_null_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect()) == [(-1, -1), (-1, 5), (-1, 5), (5, 5)]
    assert sorted((r.doc_id or -1) for r in simhash.keep_first(docs).collect()) == [-1, 5]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_chains_settle(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in graph.components(chain).collect()} == {0}
    assert graph.components(chain.limit(0)).count() == 0


def test_clustered_fingerprints_make_nodes_with_a_margin():
    """Fingerprints that agree on a group of bits and stand in clusters: their tree goes on with whole distances."""
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64) & ~np.uint64(2**13 - 1)
    near = [c ^ np.uint64(sum(1 << int(b) for b in 13 + rng.choice(51, 3, replace=False))) for c in centres for _ in range(40)]
    fps = np.unique(np.concatenate([centres, np.array(near, np.uint64), rng.integers(0, 2**63, 200, dtype=np.uint64)]))
    forest = simhash.Forest(fps, 5, 4, 16)
    margins = [node[3] for node in forest.nodes]
    assert margins.count(4) > 5
    rows, shards = forest.route(fps)
    homes = [set(shards[rows == i].tolist()) for i in range(len(fps))]
    for x in range(len(fps)):
        for y in np.flatnonzero(np.bitwise_count(fps ^ fps[x]) <= 4):
            assert homes[x] & homes[int(y)]


def test_shards_grow_with_the_table():
    rng = np.random.default_rng(4)
    sample = rng.integers(0, 2**63, 4096, dtype=np.uint64)
    work = []
    for total in (20_000, 80_000, 320_000):
        forest = simhash.Forest(sample, 5, 4, 64, total)
        _, shards = forest.route(rng.integers(0, 2**63, total, dtype=np.uint64))
        sizes = np.bincount(shards)
        work.append(int((sizes * (sizes - 1) // 2).sum()) / total)
    assert work[-1] < 3 * work[0]  # comparisons for each fingerprint
    assert [simhash.groups_for(n, 4) for n in (1, 10**6, 10**8, 10**10)] == [5, 5, 6, 7]
