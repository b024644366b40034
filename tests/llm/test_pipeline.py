import os
import re

import pytest

import corpus_pipeline
from barloom.llm import packing, pii, quality, registry, simhash

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def checked(digits):
    """Whether the last digit is a card's check digit."""
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage leaves, stored and read again."""
    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        step(spark, out[-1], DATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay_until_the_last_stage(kept):
    assert len(corpus_pipeline.STAGES) == 5
    for df in kept[1:5]:
        assert df.dtypes == kept[0].dtypes


def test_quality_rejects_what_the_model_rejects(spark, kept):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit(quality.feature_table(kept[0]), labels)
    before, after = rows(kept[0]), rows(kept[1])
    scores = {i: model.score(quality.np.array([quality.features(r.text)]))[0] for i, r in before.items()}
    assert set(after) == {i for i, s in scores.items() if s >= 0.3}
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [i for i in before if known.get(i) == 1]
    assert sum(i in after for i in good) / len(good) > 0.97


def test_one_of_each_group_stays(kept):
    before, after = rows(kept[1]), rows(kept[2])
    marks = {i: simhash.fingerprint(r.text) for i, r in before.items()}
    first = {i: i for i in marks}
    changed = True
    while changed:
        changed = False
        for i in marks:
            for j in marks:
                if first[j] < first[i] and (marks[i] ^ marks[j]).bit_count() <= 4:
                    first[i], changed = first[j], True
    assert set(after) == {i for i, f in first.items() if i == f}
    assert all(after[i] == before[i] for i in after)


def test_no_benchmark_window_is_left(spark, kept):
    before, after = rows(kept[2]), rows(kept[3])
    grams = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        grams |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    sizes = {len(g) for g in grams}
    hit = {i for i, r in before.items() for w in [words(r.text)] for n in sizes if any(tuple(w[k:k + n]) in grams for k in range(len(w) - n + 1))}
    assert set(after) == set(before) - hit and hit


def test_personal_data_is_replaced_in_place(kept):
    before, after = rows(kept[3]), rows(kept[4])
    assert set(after) == set(before)
    spot = re.compile(r"\S+@\S+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|AKIA[0-9A-Z]{16}")
    changed = 0
    for i, r in before.items():
        found = [f for f in spot.findall(r.text or "") if not re.fullmatch(r"\d{16}", f) or checked(f)]
        changed += bool(found)
        assert after[i].n_chars == len(after[i].text or "")
        assert not any(f in after[i].text for f in found)
        if not found and "password=" not in r.text and "token = " not in r.text:
            assert after[i].text == r.text
    assert changed


def test_no_assigned_secret_is_left(spark, kept):
    spot = re.compile(r"(?i)(?:token|password|passwd|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}\"?([^\s\"]{8,})")
    texts = ['TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC4"', "Password: hunter2hunter2", "db_password=abcdefgh12 and access_token=abcdefgh34",
             "CLIENT_SECRET: abcdefgh56"]
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = kept[3].select("doc_id", "text").unionByName(more)
    before, after = rows(docs), rows(dict(corpus_pipeline.STAGES)["personal_data"](spark, docs, DATA))
    found = {i: spot.findall(r.text or "") for i, r in before.items()}
    assert sum(bool(f) for f in found.values()) > len(texts)
    assert not any(f in after[i].text for i, all_ in found.items() for f in all_)


def test_all_tokens_are_packed(spark, kept):
    docs, parts = rows(kept[4]), kept[5].collect()
    encoder = packing.Encoder.of(**packing.public_vocabulary())
    total = {}
    for p in parts:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {i: len(encoder.ids(r.text or "")) + 1 for i, r in docs.items()}
    fill = {}
    for p in parts:
        fill.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for held in fill.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(held[-1]) <= 1024
    assert corpus_pipeline.run(spark, DATA).count() == len(parts)


def test_key_comes_from_the_session_or_is_random(spark):
    own = registry.surrogate_key(spark)
    assert own == registry.surrogate_key(spark) and len(own) == 32
    spark.conf.set(registry.KEY_SETTING, "k")
    try:
        assert registry.surrogate_key(spark) == "k"
    finally:
        spark.conf.unset(registry.KEY_SETTING)
