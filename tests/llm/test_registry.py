"""The registered queries over the smallest tables: their columns, and their rows against SQL or plain code."""

import html
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from barloom.llm.registry import ORACLES, QUERIES
from barloom.llm.simhash import fingerprint
from tests.llm.test_substrings import brute as brute_substrings
from workload.check import compare, oracle_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
COLUMNS = {
    "op1_neighbours": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")],
    "op2_warc": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")],
    "op3_toxicity": [("doc_id", "bigint"), ("expected_severity", "double"), ("severity", "int"), ("toxic_probability", "double"), ("toxic", "boolean")],
    "op4_decontaminate": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean")],
    "op5_substrings": [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")],
    "op6_packing": [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op7_surrogates": [("doc_id", "bigint"), ("text", "string"), ("n_replaced", "int")],
    "op8_html": [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")],
    "op9_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
    "op11_variants": [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")],
    "op13_setjoin": [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")],
    "op12_collocations": [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")],
    "op10_quality": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
}


@pytest.fixture(scope="module")
def results(spark):
    return {name: QUERIES[name](spark, SF) for name in COLUMNS}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def texts():
    return duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(results, name):
    assert results[name].dtypes == COLUMNS[name]
    assert list(QUERIES) and set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLES[name]).startswith("ok")


def test_op1_recall(results):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    got = {}
    for r in results["op1_neighbours"].collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(set(got[ids[q]]) & set(ids[np.argsort(-score)[:20]].tolist())) / 20)
    assert set(got) == set(ids[ids % 20 == 0].tolist()) and np.mean(recall) >= 0.9


def test_op5_equals_brute_force(results):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in results["op5_substrings"].collect())
    assert got == brute_substrings(texts(), 50) and any(r[2] for r in got)


def test_op8_equals_the_plain_article(results):
    pages = duckdb.execute(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in results["op8_html"].collect()}
    for page_id, page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_op9_equals_brute_force(results):
    marks = {i: fingerprint(t) for i, t in texts()}
    first = {i: i for i in marks}
    changed = True
    while changed:
        changed = False
        for i, f in marks.items():
            best = min(first[j] for j, g in marks.items() if (f ^ g).bit_count() <= 4)
            if best < first[i]:
                first[i], changed = best, True
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in results["op9_simhash"].collect()) == sorted(
        (i, f"{f:016x}", first[i]) for i, f in marks.items())


def test_op10_marks_the_held_out(results):
    for r in results["op10_quality"].collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
