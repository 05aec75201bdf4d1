import zlib
from collections import defaultdict

from demandloom.llm import sharding


def checked(placed, rows, n_shards=sharding.SHARDS):
    found = placed.collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found) == sorted((i is not None, i or 0) for i, _ in rows)
    texts = {i: t or "" for i, t in rows if i is not None}
    shards = defaultdict(list)
    for r in found:
        if r["doc_id"] is not None:
            data = texts[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n_shards
        shards[r["shard"]].append((r["slot"], r["size"]))
    for own in shards.values():
        assert sorted(s for s, _ in own) == list(range(len(own)))
    return [sum(size for _, size in own) for own in shards.values()]


def test_sizes_near_equal_with_hot_text(spark):
    rows = [(i, "hot text " * 40) for i in range(1500)] + [(10_000 + i, "x" * (i * 37 % 900)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = checked(sharding.place_by_bytes(docs), rows)
    shards = {}
    for r in sharding.place_by_bytes(docs).collect():
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    # Only the hot text, a fifth of all bytes, is spread; other equal texts stay together.
    assert [len(s) > 1 for s in shards.values()].count(True) == 1
    assert len(sizes) == 40 and max(sizes) < 1.02 * sum(sizes) / 40 and min(sizes) > 0.98 * sum(sizes) / 40


def test_odd_rows(spark, odd_docs, no_docs):
    checked(sharding.place_by_bytes(odd_docs), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert sharding.place_by_bytes(no_docs).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i) for i in range(300)], "doc_id long, text string")
    placed = sharding.place_by_bytes(docs, n_shards=4)
    sharding.write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("doc_id", "shard", "slot").collect()) == sorted(placed.select("doc_id", "shard", "slot").collect())


def test_slots_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 7)
    rows = [(i, f"t{i % 50}") for i in range(400)]
    checked(sharding.place_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 3), rows, 3)


def test_hot_repeated_rows_are_spread(spark, monkeypatch):
    """A third of the rows are one row, or have no id and one text; the law holds, and no task numbers them all."""
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 40)
    for hot in (7, None):
        rows = [(hot, "hot text " * 40)] * 2000 + [(10_000 + i, f"text {i} " * 45) for i in range(4000)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        placed = sharding.place_by_bytes(docs).collect()
        sizes, slots = defaultdict(int), defaultdict(list)
        for r in placed:
            sizes[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        mean = sum(sizes.values()) / 40
        assert len(placed) == 6000 and len(sizes) == 40
        assert max(sizes.values()) < 1.02 * mean and min(sizes.values()) > 0.98 * mean
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        hot_in = defaultdict(int)
        for r in placed:
            hot_in[r["shard"]] += r["doc_id"] == hot
        assert max(hot_in.values()) < 200


def test_placement_by_brute_force(spark, monkeypatch):
    """Ranges, pieces and shards worked out again in plain Python from the stored records and the sampled boundaries."""
    seen = {}

    def kept(records, *rest):
        seen["records"] = records.collect()
        seen["boundaries"], seen["large"] = boundaries(records, *rest)
        return seen["boundaries"], seen["large"]

    boundaries = sharding.sampled_boundaries
    monkeypatch.setattr(sharding, "sampled_boundaries", kept)
    rows = [(i, f"t{i % 900} " * (1 + i % 13)) for i in range(3000)] + [(5000 + i, "hot " * 60) for i in range(900)]
    placed = sharding.place_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 8)
    shard_of = {r["doc_id"]: r["shard"] for r in placed.collect()}
    records, cuts = seen["records"], seen["boundaries"]
    total, n_ranges = sum(r["size"] for r in records), 8 * sharding.RANGES_PER_SHARD
    even, ranges = total / n_ranges, defaultdict(list)
    for r in records:
        ranges[sum(c <= r["_key"] for c in cuts)].append(r)
    hashed = {}
    keys = spark.createDataFrame([(r["_row"], r["_key"] >> sharding.ID_BITS) for r in records], "_row long, _group long")
    for r in keys.selectExpr("_row", "xxhash64(_group) as g", "xxhash64(_row, 'piece') as own").collect():
        hashed[r["_row"]] = r["g"], r["own"]
    pieces = defaultdict(list)
    for n, own in ranges.items():
        size = sum(r["size"] for r in own)
        into = -(-size // even) if size > sharding.OVERFULL * even else 1
        for r in own:
            pieces[n, int(hashed[r["_row"]][r["_key"] >> sharding.ID_BITS in seen["large"]] % into)].append(r)
    filled, want = [0] * 8, {}
    for _, own in sorted(pieces.items(), key=lambda p: (-sum(r["size"] for r in p[1]), p[0])):
        shard = min(range(8), key=lambda s: (filled[s], s))
        filled[shard] += sum(r["size"] for r in own)
        want |= {r["doc_id"]: shard for r in own}
    assert shard_of == want and len(cuts) > 50
