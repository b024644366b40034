import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import variants


def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_pairs(words):
    words = sorted(words)
    return [(u, v) for i, u in enumerate(words) for v in words[i + 1:] if near(u, v)]


def brute(docs, least=5, shortest=6, every=199, factor=5):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= least}
    partners = {w: [] for w in n}
    for u, v in brute_pairs(n):
        partners[u].append(v)
        partners[v].append(u)
    best = {w: min(p, key=lambda x: (-n[x], x), default=None) for w, p in partners.items()}
    form = {w: b if b is not None and n[b] >= factor * n[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(partners[w]), n[form[w]] if form[w] else -1) for w in n)


def answers(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


@settings(deadline=None, max_examples=100)
@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=6), max_size=40))
def test_composition_accepts_the_pairs_one_edit_apart_once(words):
    got = [tuple(sorted(p)) for p in variants.Acceptor(sorted(words)).pairs()]
    assert sorted(got) == brute_pairs(words)


@settings(deadline=None, max_examples=50)
@given(st.sets(st.text(alphabet="abc", min_size=1, max_size=8), max_size=60))
def test_acceptor_is_minimal_and_accepts_its_words(words):
    machine = variants.Acceptor(sorted(words))

    def language(state):
        return ([""] if machine.final[state] else []) + [c + rest for c, to in machine.arcs[state].items() for rest in language(to)]

    assert sorted(language(machine.root)) == sorted(words)
    rights = [frozenset(language(s)) for s in range(len(machine.arcs))]
    assert len(rights) == len(set(rights)) or not words


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet="abÿ", min_size=1, max_size=12), st.integers(0, 12), st.integers(0, 14))
def test_gap_hashes_are_hashes_of_the_shorter_words(word, begin, end):
    whole, gaps = variants.gap_hashes(word, begin, end)
    assert whole == variants.gap_hashes(word, 0, 0)[0]
    assert gaps.tolist() == [variants.gap_hashes(word[:i] + word[i + 1:], 0, 0)[0] if len(word) > 1 else 0
                             for i in range(begin, min(end, len(word)))]


@pytest.mark.parametrize("block", [12, 400])
def test_pairs_are_those_of_brute_force_at_every_block_size(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(60)}
    words |= {"aaaaaaaaaa" + w for w in list(words)[:20]} | {"é" + w for w in list(words)[:10]}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    got = variants.near_pairs(df, block).collect()
    assert all(r.n_u == len(r.u) and r.n_v == len(r.v) for r in got)
    assert sorted(tuple(sorted((r.u, r.v))) for r in got) == brute_pairs(words)


def test_long_words_that_share_all_but_a_letter(spark):
    long = "x" * 40_000
    words = [long, long + "y", long[:20_000] + "é" + long[20_001:], long + "yz"]
    df = spark.createDataFrame([(w, 9) for w in words], "word string, n long")
    got = {frozenset((words.index(r.u), words.index(r.v))) for r in variants.near_pairs(df, 50_000).collect()}
    assert got == {frozenset(p) for p in ((0, 1), (0, 2), (1, 3))}


def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(5, 8))) for _ in range(25)]
    damaged = [w[:2] + rng.choice("abcdefgÉ") + w[2 + rng.randint(0, 1):] for w in base * 3]
    docs = []
    for i in range(120):
        words = [rng.choice(base) if rng.random() < 0.8 else rng.choice(damaged) for _ in range(60)]
        docs.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + "."))
    return docs + [(None, docs[0][1]), (3, docs[3][1]), (3, docs[3][1]), (200, None), (201, ""), (202, "1 - 2"), (203, "ÀÖ×÷ØÿĀ" * 9)]


@pytest.mark.parametrize("block", [40])
def test_equals_brute_force(spark, block):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    vocabulary = variants.word_counts(df, shortest=5, least=3, every=7)
    want = brute(docs, least=3, shortest=5, every=7, factor=2)
    assert answers(variants.variants(vocabulary, factor=2, block=block)) == want
    assert any(w[1] for w in want) and any(w[1] != w[2] and w[1] for w in want)


def test_chain_of_forms_ends_at_its_root(spark):
    words = [("a" * i, 5**i) for i in range(1, 13)]
    got = {r.word: r.root for r in variants.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 12}


def test_ties_take_the_smaller_word(spark):
    words = [("aaaaaa", 2), ("baaaaa", 10), ("aaaaab", 10), ("éaaaaa", 10), ("zzzzzz", 1)]
    got = {r.word: r for r in variants.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["aaaaaa"].form == "aaaaab" and got["aaaaaa"].n_near == 3 and got["aaaaaa"].form_n == 10
    assert got["zzzzzz"].form is None and got["zzzzzz"].root == "zzzzzz" and got["zzzzzz"].n_near == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(variants.word_counts(empty)).collect() == []
