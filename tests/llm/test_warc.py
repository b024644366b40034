import gzip
import hashlib
import random

import pytest

from barloom.llm import registry, warc


def made(n):
    return [warc.record(f"<urn:x-page:{i}>", f"http://a/{i}", b"body %d WARC/1.1\r\n\x1f\x8b\x08 " % i * (i + 1)) for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_file_has_all_records_and_no_gap(packed):
    records = made(6)
    data = b"".join(gzip.compress(r, mtime=0) if packed else r for r in records)
    rows = list(warc.salvage(data))
    assert [r["record_id"] for r in rows] == [f"<urn:x-page:{i}>" for i in range(6)]
    assert sum(r["length"] for r in rows) == len(data)
    assert rows[3]["payload_digest"] == hashlib.sha1(rows[3]["payload"]).hexdigest()


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("seed", range(12))
def test_damage_costs_only_the_damaged_records(packed, seed):
    rng = random.Random(seed)
    units = [gzip.compress(r, mtime=0) if packed else r for r in made(8)]
    hit = sorted(rng.sample(range(8), 2))
    damaged = list(units)
    for i in hit:
        u = bytearray(units[i])
        middle = len(u) // 2 if packed else u.index(b"\r\n\r\n") + 12  # nothing checks the fields of a plain record
        kind = rng.choice(["flip", "cut", "insert"])
        if kind == "flip":
            at = rng.randrange(middle, len(u) - 8)
            u[at] ^= 0x41
        elif kind == "cut":
            del u[middle:]
        else:
            u[middle:middle] = bytes(rng.randrange(256) for _ in range(40))
        damaged[i] = bytes(u)
    data = b"junk" + b"".join(damaged)
    rows = list(warc.salvage(data))
    good = [r["record_id"] for r in rows if r["kind"] == "record"]
    assert good == [f"<urn:x-page:{i}>" for i in range(8) if i not in hit]
    assert all(r["payload"] == b"body %d WARC/1.1\r\n\x1f\x8b\x08 " % i * (i + 1) for i, r in
               zip([i for i in range(8) if i not in hit], [r for r in rows if r["kind"] == "record"]))
    ends = 0
    for r in rows:  # records and gaps cover the file
        assert r["offset"] == ends
        ends += r["length"]
    assert ends == len(data)
    assert next(r for r in rows if r["kind"] == "gap")["offset"] == 0


@pytest.mark.parametrize("data", [b"", b"nothing here", b"\x1f\x8b\x08", b"WARC/1.1\r\n", b"WARC/1.1\r\nContent-Length: 5\r\n\r\n", warc.EMPTY_MEMBER])
def test_files_without_records(data):
    assert not [r for r in warc.salvage(data) if r["kind"] == "record"]


def test_pages_come_back(spark, tmp_path):
    long = "é" * 600
    rows = [(1, "http://x", long), (2, None, long), (9, "http://x\r\nWARC-Type: evil", long), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
            (None, "u", long), (9, "again", long), (6, "", "x" * 300_000), (7, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(i, u, h, "d") for i, u, h in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, file_bytes=700)
    out = warc.read_archive(spark, path).withColumn("page_id", warc.page_id(warc.F.col("record_id"))).withColumn(
        "target", warc.page_id(warc.F.col("refers_to"))).collect()
    assert {r.kind for r in out} == {"record"}
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.target) for r in out)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = h == long and i != 9
        want.append((i or -1, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 9 if again else None))
    assert got == sorted(want, key=lambda r: r[:4])
    assert all(r.payload == (dict((i, h) for i, _, h in rows)[r.page_id] or "").encode() for r in out if r.record_type == "response")
    assert all(r.payload is None for r in out if r.record_type == "revisit")


def test_files_are_bounded_by_bytes_and_hold_every_byte_value(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 2000)
    rng = random.Random(5)
    pages = [(i, rng.randbytes(rng.choice([10, 500, 1500, 9000]))) for i in range(60)]
    path = tmp_path / "archive"
    df = spark.createDataFrame(pages, "page_id long, html binary").withColumn("url", warc.F.lit("u")).coalesce(1)
    warc.write_archive(df, str(path), file_bytes=20_000)
    files = [f.read_bytes() for f in path.glob("part-*")]
    largest = max(len(gzip.compress(warc.record("<urn:x-page:10>", "u", p), 4)) for _, p in pages)
    lines = 20_000 // 2000
    assert len(files) > 5 and max(map(len, files)) <= 20_000 + largest + lines * len(warc.EMPTY_MEMBER)
    assert {b for f in files for b in f} == set(range(256))
    got = {warc.re.search(r"\d+", r.record_id)[0]: r.payload for r in warc.read_archive(spark, str(path)).collect() if r.kind == "record"}
    assert got == {str(i): p for i, p in pages}


def test_large_members_of_the_own_archive(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "u", "x" * 300_000), (2, "u", "y")], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    whole = warc.read_archive
    bounds = []

    def read(*args, max_member=1000, **more):
        bounds.append(max_member)
        return whole(*args, max_member=max_member, **more)

    monkeypatch.setattr(warc, "read_archive", read)
    got = registry.QUERIES["op2_warc"](spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [(1, 300_000), (2, 1)]
    assert bounds == [None]
    monkeypatch.setattr(warc, "read_archive", lambda *args, **more: whole(*args, **more | {"max_member": 1000}))
    with pytest.raises(Exception, match="gap in .* member too large"):
        registry.QUERIES["op2_warc"](spark, str(tmp_path)).collect()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0
