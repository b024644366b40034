import re

import pytest

from barloom.llm import decontaminate


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, n):
    grams = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + k]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    found |= grams[tuple(w[i:i + k])]
        out.append((doc, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


ITEMS = [(1, "the quick brown fox jumps over"), (2, "a b c"), (10, "Brown FOX, jumps over the"), (3, None), (4, "..."), (None, "single"),
         (5, "É été d'été"), (1, "zz yy xx ww")]
DOCS = [(1, "x The QUICK brown fox jumps over the lazy dog"), (2, "a b a b c c"), (3, None), (4, ""), (None, "single single"), (5, "É Été D'été é"),
        (6, "nothing here at all"), (2, "a b a b c c"), (2, "other text a, b; c"), (7, "w " * 30_000 + "zz yy xx ww"), (8, "quick brown fox")]


@pytest.mark.parametrize("block", [1, 3, 500_000])
def test_equals_brute_force(spark, block):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in DOCS], "doc_id long, text string, items string, hash int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.scan(docs, items, n=4, block_windows=block).collect()
    assert sorted(((r.doc_id, r.n_words, r.hits, r["items"]) for r in got), key=str) == brute(DOCS, ITEMS, 4)
    clean = decontaminate.remove_documents(docs, items, n=4, block_windows=block)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(
        ((d, t) for d, t in DOCS if not next(h for i, n, h, _ in brute([(d, t)], ITEMS, 4))), key=str)


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.hits): r.text for r in decontaminate.remove_spans(docs, items, n=4).where("doc_id != 2").collect()}
    assert got[1, "x"] == "x lazy dog" and got[6, "x"] == "nothing here at all" and got[3, "x"] is None
    assert got[7, "x"] == "w " * 30_000


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.scan(docs.limit(0), items).count() == 0
    none = decontaminate.scan(docs, items.limit(0)).collect()
    assert len(none) == len(DOCS) and not any(r.hits or r["items"] for r in none)
    assert decontaminate.remove_documents(docs, items.limit(0)).count() == len(DOCS)
