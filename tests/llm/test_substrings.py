import hashlib

import numpy as np
import pytest

from barloom.llm import substrings


def brute(rows, window):
    """n_words, n_removed and digest by definition; rows of (id, text)."""
    split = [("" if t is None else t).encode().split() for _, t in rows]
    order = [2**63 if i is None else i for i, _ in rows]
    first = {}
    for o, words in zip(order, split):
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            first[gram] = min(first.get(gram, o), o)
    out = []
    for (i, _), o, words in zip(rows, order, split):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < o:
                gone.update(range(at, at + window))
        kept = [w for at, w in enumerate(words) if at not in gone]
        out.append((-1 if i is None else i, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("period", [1, 2, 3, 7, 13, 21, 31])
def test_cover_has_every_difference(period):
    cover = substrings.difference_cover(period)
    for a in range(period):
        for b in range(period):
            assert any((a + k) % period in cover and (b + k) % period in cover for k in range(period))
    assert period != 31 or len(cover) == 6


def test_rolling_hash_depends_on_the_words_alone():
    words = "a b c d a b c d e a b c".split()
    hashes = substrings.rolling(substrings.word_hashes([w.encode() for w in words]), 3, substrings.BASES[0])
    grams = [tuple(words[i:i + 3]) for i in range(10)]
    for x, g in zip(hashes, grams):
        for y, h in zip(hashes, grams):
            assert (x == y) == (g == h)


@pytest.mark.parametrize("seed,window,period,parts", [(0, 6, 3, 1), (1, 6, 3, 5), (2, 8, 7, 7), (3, 5, 1, 3), (4, 50, 31, 4)])
def test_equals_brute_force(spark, seed, window, period, parts):
    rng = np.random.default_rng(seed)
    vocabulary = ["w%d" % i for i in range(6 if window < 20 else 400)]
    passages = [list(rng.choice(vocabulary, int(rng.integers(window - 1, 3 * window)))) for _ in range(5)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(int(rng.integers(0, 5))):
            words += list(rng.choice(vocabulary, int(rng.integers(0, window)))) if rng.random() < 0.5 else passages[int(rng.integers(5))]
        texts.append(" ".join(words) + " \n\t")
    texts += [texts[3]] * 30 + [None, "", "x " * 3_000, "x " * 3_000, "a b c"]
    ids = rng.permutation(len(texts)).tolist()
    rows = list(zip(ids, texts)) + [(ids[0], texts[0]), (ids[1], texts[2]), (None, texts[4]), (None, "x " * 100)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int").repartition(parts)
    got = substrings.remove_repeats(docs, window, period).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows, window)
    texts_kept = substrings.remove_repeats(docs, window, period, with_text=True).where("n_removed > 0").collect()
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in texts_kept)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(docs).count() == 0
