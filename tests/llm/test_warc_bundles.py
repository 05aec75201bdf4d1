import base64
import hashlib
import random
import struct
from pathlib import Path

import pytest
import zstandard

from demandloom.llm import warc_bundles as w

DDL = "page_id long, url string, html string, payload string, _digest string, bundle int"


@pytest.fixture(scope="module")
def pages(spark):
    html = [None, "", "<p>é\r\n\r\nWARC/1.1\r\n</p>", "<p>b</p>", "x" * 700_000] + [f"page {i}" * 50 for i in range(60)] + ["hot"] * 40
    rows = [(i, f"http://h/{i}\r\nX: y", h, "p", "d", 1) for i, h in enumerate(html)]
    rows += [(500, None, "<p>b</p>", "", "", 2), (501, "u", "twin", "", "", 2), (501, "u", "twin", "", "", 2), (None, None, "page 0" * 50, "", "", 3), (None, None, "alone", "", "", 3)]
    return spark.createDataFrame(rows, DDL)


def want(rows):
    groups = {}
    for page, payload in rows:
        groups.setdefault(payload, []).append(page)
    out = []
    for page, payload in rows:
        data = payload.encode()
        top = max((p for p in groups[payload] if p is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, *(("response", None) if page == top else ("revisit", top))))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    index = w.archive(pages)
    rows = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    back = w.read_records(index)
    found = back.collect()
    assert sorted([tuple(r)[:1] + tuple(r)[2:] for r in found], key=str) == want(rows)
    texts = dict(r for r in rows if r[0] is not None)
    for r in found:
        if r["page_id"] is not None:
            assert r["payload"] == (texts[r["page_id"]] if r["record_type"] == "response" else None)
    one = w.read_records(index.where("page_id = 4")).collect()
    assert [(r["page_id"], r["payload_bytes"]) for r in one] == [(4, 700_000)]


def test_bundles_are_seekable_and_plain_zstandard(spark, pages):
    index = w.archive(pages.repartition(2))
    for uri in {r["bundle"] for r in index.collect()}:
        store, path = w.open_store(uri)
        table = w.seek_table(store.open_input_file(path))
        data = Path(path).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        parts = [zstandard.ZstdDecompressor().decompress(data[a : a + n]) for a, n, _ in table]
        assert [len(x) for x in parts] == [size for _, _, size in table]
        assert whole.startswith(b"".join(parts)) and len(whole) == sum(map(len, parts))
        at, count = 0, 0
        while at < len(whole):
            _, _, at = w.parse_record(whole, at)
            count += 1
        assert count == index.where(index["bundle"] == uri).count()
        assert struct.unpack("<I", data[-4:])[0] == w.SEEKABLE


def test_least_bytes_damage_and_no_pages(spark, pages):
    kept = w.read_records(w.archive(pages, least_bytes=10_000)).where("record_type = 'revisit'")
    assert kept.count() == 0
    assert w.read_records(w.archive(pages.where("false"))).count() == 0
    record = w.record_bytes(1, None, b"body", w.digest_of(b"body"), None)
    with pytest.raises(ValueError):
        w.parse_record(record[:-2] + b"xx")


def test_frames_are_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "http://x/", "".join(rng.choice("abcdefgh ") for _ in range(900))) for i in range(200)]
    index = w.write_bundles(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}", frame_bytes=2000)
    records = w.read_records(index, read_bytes=4000)
    assert records.rdd.getNumPartitions() >= 10
    tasks = [n for n in records.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(tasks) >= 10 and sum(tasks) == 200 and max(tasks) < 60
