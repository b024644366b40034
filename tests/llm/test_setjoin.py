import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import setjoin


def brute_set(text, size=5):
    words = [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ") if w]
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size=5, percent=80):
    """rows of (id, text) with an id each: (id, set size, smallest id reachable)."""
    sets = [brute_set(t, size) for _, t in rows]
    smallest = [i for i, _ in rows]
    links = [(x, y) for x in range(len(rows)) for y in range(x) if sets[x] and sets[y]
             and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])]
    changed = True
    while changed:
        changed = False
        for x, y in links:
            least = min(smallest[x], smallest[y])
            if smallest[x] != least or smallest[y] != least:
                smallest[x] = smallest[y] = least
                changed = True
    return sorted((i, len(s), least) for (i, _), s, least in zip(rows, sets, smallest))


def answers(df):
    assert df.columns == ["doc_id", "text_key", "n_shingles", "component_id"]
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet="aAbÉé \n\t\x0b\x85 ", max_size=60))
def test_shingles_are_as_many_as_defined(text):
    assert len(setjoin.shingles(text, 3)) == len(brute_set(text, 3))


@settings(deadline=None, max_examples=300)
@given(st.integers(1, 700), st.integers(0, 90), st.integers(0, 90), st.integers(0, 2**32), st.sampled_from([50, 70, 80, 90, 100]))
def test_linked_sets_send_a_common_part(size, lost, gained, seed, percent):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[min(lost, size - 1):], rng.integers(0, 2**63, gained, dtype=np.uint64)]))
    both = len(np.intersect1d(a, b))
    apart = len(a) + len(b) - 2 * both
    x, y = sorted((setjoin.sketch(a), setjoin.sketch(b)), key=len)
    while len(x) < len(y):
        y = setjoin.folded(y)
    assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= apart
    if 100 * both >= percent * (len(a) + len(b) - both):
        assert percent < 60 or len(setjoin.sketch(a)) in (len(setjoin.sketch(b)), 2 * len(setjoin.sketch(b)), len(setjoin.sketch(b)) // 2)
        assert apart <= setjoin.differing(len(a) + len(b), percent)
        assert len(np.intersect1d(setjoin.part_keys(a, percent), setjoin.part_keys(b, percent)))


def near_copies(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=30))
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.5:
            text = rng.choice(docs)[1].split(" ")
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            docs.append((i, " ".join(text + [rng.choice(words)] * rng.randint(0, 2))))
        else:
            body = " ".join(rng.choices(words, k=rng.choice([1, 3, 4, 5, 6, 9, 12, 40, 90, 200])))
            docs.append((i, f"{passage} {body}" if kind < 0.8 else body))
    return docs


@pytest.mark.parametrize("seed, size, percent, block", [(1, 5, 80, 4096), (2, 1, 60, 3)])
def test_equals_brute_force(spark, seed, size, percent, block):
    docs = near_copies(seed)
    rng = random.Random(seed)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rng.sample(docs, len(docs))], "doc_id long, text string, class string, hash int")
    want = brute(docs, size, percent)
    assert answers(setjoin.similar_sets(df.repartition(7), size=size, percent=percent, block=block)) == want
    assert any(r[0] != r[2] for r in want)


def test_group_that_shares_a_part_but_no_hub(spark):
    """Two families that share much with a common hub, but link only among themselves."""
    rng = random.Random(9)
    hub = [f"h{i}" for i in range(300)]
    families = [[f"f{k}_{i}" for i in range(180)] for k in range(2)]
    docs = [(0, " ".join(hub))]
    for i in range(1, 41):
        text = hub[:(200, 205, 215)[i % 3]] + families[i % 2]
        text[rng.randrange(len(text))] = f"x{i}"
        docs.append((i, " ".join(text)))
    got = answers(setjoin.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"), size=1, block=8))
    assert got == brute(docs, 1) and {r[2] for r in got} == {0, 1, 2}


def test_open_groups_are_not_compared_again_where_all_proposed_pairs_are_links(spark, monkeypatch):
    rng = random.Random(4)
    hub = [f"h{i}" for i in range(300)]
    families = [[f"f{k}_{i}" for i in range(180)] for k in range(2)]
    docs = [(0, " ".join(hub))]
    for i in range(1, 41):
        text = hub[:200] + families[i % 2]
        text[rng.randrange(200, 380)] = f"x{i}"
        docs.append((i, " ".join(text)))
    seen, made = [], setjoin._pairs_within
    monkeypatch.setattr(setjoin, "_pairs_within", lambda percent, spanning: seen.append(spanning) or made(percent, spanning))
    assert answers(setjoin.similar_sets(spark.createDataFrame(docs, "doc_id long, text string"), size=1, block=8)) == brute(docs, 1)
    assert seen == [True]


def test_nulls_empty_texts_copies_and_repeated_ids(spark):
    long = " ".join(str(i) for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (6, "a  b"), (7, "b a"), (4, "c d"), (None, "a b"), (None, "c d"), (9, long),
            (9, long), (10, long + " end"), (None, "alone"), (11, "1 2 3 4 5"), (12, "1 2 3 4 5 6")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = setjoin.similar_sets(df).collect()
    assert len(got) == len(rows)
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got)
    assert found == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 4), (7, 1, 7), (4, 1, 4), (0, 1, 4), (0, 1, 4),
                            (9, 19_996, 9), (9, 19_996, 9), (10, 19_997, 9), (0, 1, 0), (11, 1, 11), (12, 2, 12)])


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=40))
def test_spanning_pairs_join_what_all_pairs_join(pairs):
    x, y = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    labels = np.arange(15)
    kept = setjoin._spanning(labels, x, y)
    full = list(range(15))
    for a, b in pairs:
        old, new = max(full[a], full[b]), min(full[a], full[b])
        full = [new if f == old else f for f in full]
    assert len({tuple(labels == v) for v in labels}) == len(set(full)) and all(labels[a] == labels[b] for a, b in pairs)
    assert len(kept) == 15 - len(set(full))


def test_parts_that_go_on_over_batches():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    rows = sorted(map(tuple, rng.integers(0, 4, (200, 3)).tolist()))
    want = set()
    for part in range(4):
        inside = sorted({r[1:] for r in rows if r[0] == part})
        want |= {(part, inside[0], r) for r in inside} if len(inside) > 1 else set()
    for step in (1, 2, 3, 7, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + step])], ["part", "c1", "c2"])
                   for i in range(0, len(rows), step)]
        got = [(p, tuple(np.frombuffer(h, np.int64)), tuple(np.frombuffer(c, np.int64)))
               for b in setjoin._shared(iter(batches)) for p, h, c in zip(*(x.to_pylist() for x in b.columns))]
        assert len(got) == len(set(got)) and set(got) == want


def test_empty_table(spark):
    assert setjoin.similar_sets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sent_parts_take_little_room_and_come_back_whole():
    """A part of a set of 700 words took 24 bytes, class and all; packed for 50 buckets it takes less than 14."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(700)) for _ in range(200)] + ["", None, "one two", "one two three four five six"] + [
        " ".join(f"v{i}" for i in range(20_000))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    packed = list(setjoin._sent(5, 80, 50)(iter([batch])))
    rows = [row for b in setjoin._unpacked(iter(packed)) for row in zip(*(c.to_pylist() for c in b.columns))]
    want = [(int(k), *np.frombuffer(setjoin.set_class(s), np.int64).tolist()) for t in texts for s in [setjoin.shingles(t)] for k in setjoin.part_keys(s, 80)]
    assert sorted(rows) == sorted(want)
    assert all(row[0] % 50 == b for p in packed for k in range(p.num_rows) for b in [p.column(0)[k].as_py()]
               for u in setjoin._unpacked(iter([p.slice(k, 1)])) for row in zip(u.column(0).to_pylist()))
    assert sum(len(x) for p in packed for c in p.columns[1:] for x in c.to_pylist()) < 14 * len(rows)
