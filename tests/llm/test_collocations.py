import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.llm import collocations


def brute_pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^ \t]+", piece) for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def brute(docs, least, longest=5, scale=1000, inside=100, top=2000):
    langs, out = {}, []
    for lang, text in docs:
        langs.setdefault(lang or "und", []).extend(brute_pieces(text))
    for lang, pieces in langs.items():
        f = Counter(tuple(p[i:i + k]) for p in pieces for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        n = sum(map(len, pieces))
        common = {p: a for p, a in f.items() if a >= least}
        rows = []
        for p, a in common.items():
            longer = [b for q, b in common.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if len(p) == 1 or any(100 * b >= inside * a for b in longer):
                continue
            score, _, l, r = min((scale * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, n, -score) for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def answers(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet="aAÉé .,\n\t\x0b\x85!", max_size=60))
def test_tokens_are_the_words_of_the_pieces(text):
    got = [[]]
    for t in collocations.tokens(text):
        if t == collocations.BREAK:
            got.append([])
        else:
            got[-1].append(t.decode())
    assert got == brute_pieces(text)


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 4), st.integers(1, 60), st.integers(1, 200), st.integers(0, 2**32))
def test_trie_accepts_its_phrases_alone(k, top, n, seed):
    rng = np.random.default_rng(seed)
    rows = collocations._distinct(rng.integers(1, top + 1, (n, k)).astype(np.int32))
    trie = collocations.Trie(rows)
    text = np.append(rng.integers(0, top + 3, 400), np.append(rows.ravel(), 0)).astype(np.int32)
    got = np.bincount(trie.phrase[trie.advance(text, collocations._places(text, k))], minlength=len(rows))
    want = Counter(tuple(text[i:i + k].tolist()) for i in range(len(text) - k + 1))
    assert got.tolist() == [want[tuple(r)] for r in rows.tolist()]


def test_trie_with_parents_of_very_many_children():
    rng = np.random.default_rng(3)
    rows = [(1, c) for c in range(1, 5000)] + [(2, int(c)) for c in rng.choice(5000, 2500, replace=False) + 1]
    rows += [(int(a), int(b)) for a, b in rng.integers(3, 5000, (5000, 2))]
    rows = collocations._distinct(np.array(rows, np.int32))
    trie = collocations.Trie(rows)
    text = np.append(np.column_stack([rows, np.zeros(len(rows), np.int32)]).ravel(), 0).astype(np.int32)
    hits = trie.phrase[trie.advance(text, collocations._places(text, 2))]
    assert sorted(hits.tolist()) == list(range(len(rows)))
    assert len(trie.check) < 4 * len(rows) + 20_000


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2), max_size=30))
def test_closed_blocks_hold_the_same_runs(ids):
    def runs(x):
        return [r for r in "".join(map(str, x)).split("0") if r]

    got = collocations._closed(np.array(ids, np.int32)).tolist()
    assert runs(got) == runs(ids) and (not got or got[-1] == 0) and [0, 0] not in [got[i:i + 2] for i in range(len(got))]


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    words = {"en": ["the", "of", "New", "york", "city", "hall", "a", "is", "É"], "de": ["der", "die", "of", "bahn", "hof"]}
    fixed = {"en": "New York city hall is", "de": "der bahn hof"}
    docs = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        out = []
        for _ in range(rng.randint(0, 12)):
            out.append(fixed[lang or "de"] if rng.random() < 0.3 else rng.choice(words[lang or "de"]))
            out.append(rng.choice([" ", " ", " ", "\t ", ", ", "\n", "."]))
        docs.append((lang, "".join(out)))
    return docs + [("xx", None), ("xx", ""), ("yy", "\n.\n"), (None, docs[0][1]), docs[1], docs[1]]


@pytest.mark.parametrize("least, inside, top, dictionary, shard", [(4, 100, 2000, 500_000, 1_000_000), (2, 60, 7, 3, 5)])
def test_equals_brute_force(spark, least, inside, top, dictionary, shard):
    docs = corpus(least)
    df = spark.createDataFrame([(lang, t, "x", 1, 2) for lang, t in docs], "lang string, text string, word string, id int, f int")
    want = brute(docs, least, inside=inside, top=top)
    got = collocations.collocations(df.repartition(5), least=least, inside=inside, top=top, dictionary=dictionary, shard=shard)
    assert answers(got) == want and {len(r[2].split(" ")) for r in want} >= {2, 3}


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**15, 10**16, 10**8, 10**9)], "a long, n long, l long, r long").select(
        collocations._exact(F.lit(1000), F.col("a"), F.col("n")).alias("above"), collocations._exact(F.col("l"), F.col("r")).alias("below"))
    assert df.selectExpr("above div below AS score").first().score == 10**17


def test_empty_table_and_no_common_word(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []


def test_candidates_are_the_common_phrases_alone(spark):
    """Of 300,000 rare phrases some share a bit of the bitmap with a common one; they are no candidates."""
    rng = np.random.default_rng(5)
    common = rng.permutation(4000).astype(np.int32).reshape(-1, 2) + 1
    rare = rng.integers(5001, 60000, (300_000, 2)).astype(np.int32)
    blocks = [np.column_stack([rows, np.zeros(len(rows), np.int32)]).ravel().tobytes() for rows in [*[common] * 4, *np.split(rare, 10)]]
    texts = spark.createDataFrame([(bytearray(b),) for b in blocks], "ids binary").repartition(4)
    found = collocations.candidates(texts, 2, None, None, 4)
    assert sorted((r.w1, r.w2) for r in found.collect()) == sorted(map(tuple, common.tolist()))
    assert [r.id for r in found.orderBy("w1", "w2").collect()] == list(range(1, len(common) + 1))
