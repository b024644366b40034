import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import packing

VOCABULARY = packing.public_vocabulary()


@settings(deadline=None, max_examples=80)
@given(st.text(max_size=80))
def test_both_encoders_agree(text):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(VOCABULARY["path"]).encode(text, add_special_tokens=False).ids
    assert packing.Encoder.of(**VOCABULARY).ids(text).tolist() == want
    special = f"{text}<|endoftext|>{text}"
    assert 50256 in packing.Encoder.of(**VOCABULARY).ids(special)


@settings(deadline=None, max_examples=100)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=6))
def test_first_bin_has_the_least_slack_possible(histogram):
    chosen = packing._fullest(sorted(histogram), histogram, 12)
    longest, rest = max(histogram), dict(histogram)
    rest[longest] -= 1
    ranges = [range(rest[n] + 1) for n in rest]
    fullest = max(t for ks in itertools.product(*ranges) if (t := longest + sum(n * k for n, k in zip(rest, ks))) <= 12)
    assert sum(n * k for n, k in chosen.items()) == fullest
    assert all(k <= histogram[n] for n, k in chosen.items())
    left = dict(histogram)
    for combination, times in packing.plan(histogram, 12):
        for n, k in combination.items():
            left[n] -= k * times
    assert not any(left.values())


@pytest.mark.parametrize("bucket", [3, 200_000])
def test_pieces_fill_sequences_without_gaps(spark, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_PIECES", bucket)
    rng = np.random.default_rng(1)
    texts = [" ".join(["tok"] * int(n)) for n in rng.integers(0, 60, 120)] + ["same text"] * 40 + [None, "", "word " * 5_000]
    docs = spark.createDataFrame([(i if i % 50 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    rows = packing.pack_documents(docs, VOCABULARY, capacity=32, with_ids=True).collect()
    encoder = packing.Encoder.of(**VOCABULARY)
    whole = sorted(tuple(encoder.ids(t or "").tolist() + [2]) for t in texts)
    assert sum(r.length for r in rows) == sum(map(len, whole))
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    assert all(r.length == 32 for r in rows if r.piece)
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in groups.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 32
    total = sum(map(len, whole))
    assert len(groups) <= -(-total // 32) + 2
    sequences = packing.sequences(spark.createDataFrame(rows)).collect()
    assert sum(len(s.ids) for s in sequences) == total


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, VOCABULARY).count() == 0
    assert packing.cut_points(1024, 1024) == [(0, 1024)] and packing.cut_points(1025, 1024) == [(0, 1), (1, 1024)]
