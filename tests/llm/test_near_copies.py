import random

import numpy as np
from pyspark.sql import functions as F

from demandloom.llm import near_copies as n


def similarity(a, b):
    x, y = ({*map(tuple, zip(*(t.split()[k:] for k in range(5))))} for t in (a, b))
    return len(x & y) / len(x | y)


def changed(rng, text, times):
    words = text.split()
    for i in rng.sample(range(len(words)), times):
        words[i] = f"other{rng.randrange(10**6)}"
    return " ".join(words)


def test_every_row_is_kept_or_close_to_one_kept(spark):
    rng = random.Random(21)
    say = lambda size: " ".join(f"w{rng.randrange(5000)}" for _ in range(size))
    texts = []
    for _ in range(12):
        texts.append(say(200))
        texts += [changed(rng, texts[-1], rng.randint(1, 8)) for _ in range(4)]
        for _ in range(4):  # a chain whose ends are not close
            texts.append(changed(rng, texts[-1], 3))
    base = say(200)
    texts += [changed(rng, base, 1) for _ in range(60)]
    rng.shuffle(texts)
    kept = {r[0] for r in n.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        close = {j for j in kept if j != i and similarity(texts[j], text) >= 0.8}
        assert (i in kept) == (not close), (i, close)
        assert i in kept or min(close) < i


def test_odd_rows(spark, odd_docs, no_docs):
    kept = n.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    texts = [r["text"] for r in rows if r["doc_id"] is not None]
    words = [" ".join((t or "").lower().split()) for t in texts]
    assert len(words) == len(set(words)) and sum(r["doc_id"] is None for r in rows) == 2
    assert n.keep_one(no_docs).count() == 0


def test_rows_that_share_only_their_id_stay(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(1, a), (1, b), (1, a), (2, b), (3, a + " tail"), (0, b.upper())]
    kept = n.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == sorted([(0, b.upper()), (1, a)])
    other = n.keep_one(spark.createDataFrame([(1, a), (1, b)], "doc_id long, text string"))
    assert sorted(tuple(r) for r in other.collect()) == [(1, a), (1, b)]


def test_columns_of_any_name(spark):
    a = " ".join(f"w{i}" for i in range(80))
    rows = [(2, a, 5), (1, a + " tail", 6), (1, a + " tail", 6), (None, a, 7)]
    for columns in (("node", "hashes", "doc_id"), ("doc_id", "text", "_node"), ("a", "b", "key"), ("id", "row", "least_id")):
        docs = spark.createDataFrame(rows, f"{columns[0]} long, {columns[1]} string, {columns[2]} int")
        kept = n.keep_one(docs, columns[0], columns[1])
        assert kept.columns == list(columns) and sorted(map(str, kept.collect())) == sorted(map(str, [docs.collect()[1], docs.collect()[3]]))


def test_recall_in_a_corpus_of_one_template(spark):
    """Documents that share most of a template but are not close, with close pairs among them."""
    rng = random.Random(77)
    template = [f"t{i}" for i in range(130)]
    texts = []
    for k in range(150):
        own = [f"d{k}x{i}" for i in range(60)]
        texts.append(" ".join([*template, *own]))
        if k % 3 == 0:
            texts.append(changed(rng, texts[-1], 2))
    rng.shuffle(texts)
    kept = [r[1] for r in n.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()]
    assert len(kept) == 150
    assert not any(similarity(x, y) >= 0.8 for i, x in enumerate(kept) for y in kept[:i])


def test_candidates_are_chains_of_fingerprints(spark):
    """Sets that share four fifths meet in a key by fingerprints and chains alone; others don't."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(300):
        common, own, other = (rng.integers(0, 1 << 63, size, dtype=np.uint64) for size in (160, 20, 20))
        rows += [(2 * k, n.ring(np.concatenate([common, own]))), (2 * k + 1, n.ring(np.concatenate([common, other])))]
    keyed = n.chains(spark.createDataFrame(rows, "rank long, ring array<long>"))
    pairs = {(r["head"], r["rank"]) for r in n._met(keyed, ["key"], 9).collect()}
    assert pairs >= {(2 * k, 2 * k + 1) for k in range(300)}
    assert len(pairs) < 310
    # Keys dealt out in pairs of blocks give the same.
    hot = keyed.select("key").distinct().withColumn("blocks", F.lit(3))
    assert {(r["head"], r["rank"]) for r in n._met(n._dealt(keyed, hot), ["key", "low", "high"], 9).collect()} == pairs


def test_every_link_of_a_group_is_tested(spark):
    """Many variants of one text, most pairs of which are near 0.8: none that stays is close to another."""
    rng = random.Random(31)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(150))
    texts = [changed(rng, base, rng.randint(2, 6)) for _ in range(150)]
    kept = [r[0] for r in n.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()]
    expected = []
    for i, text in enumerate(texts):
        if not any(similarity(texts[j], text) >= 0.8 for j in expected):
            expected.append(i)
    assert 5 < len(expected) < 140 and sorted(kept) == expected


def test_a_group_gives_rows_in_proportion(spark, tmp_path, monkeypatch):
    """Of a group of near copies a key gives one candidate a document, and a round reads only what is open."""
    monkeypatch.setattr(n, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    rng = random.Random(5)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(150))
    texts = [base, *(changed(rng, base, 1) for _ in range(199))]
    assert [r[0] for r in n.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()] == [0]
    rows = lambda name: sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "near-copies").glob(f"{name}-*"))
    assert rows("met") <= len(texts) * n.SEGMENTS
    assert rows("pairs") == len(texts) - 1
    first = spark.read.parquet(str(tmp_path / "near-copies" / "left-0")).count()
    assert rows("left") == first


def rows_of_rings(spark):
    """Rings that differ from one of five in some bits."""
    rng = np.random.default_rng(12)
    bases = rng.integers(0, 2, (5, n.SEGMENTS * 8), dtype=np.uint8)
    rings = [np.packbits(bases[k % 5] ^ (rng.random(n.SEGMENTS * 8) < rng.choice([0.03, 0.08, 0.11]))) for k in range(120)]
    rows = [(k, r.view(np.int64).tolist()) for k, r in enumerate(rings)]
    return rings, spark.createDataFrame(rows, "rank long, ring array<long>")


def test_a_bitmap_leaves_the_keys_wanted(spark):
    _, nodes = rows_of_rings(spark)
    everything = n.chains(nodes).collect()
    keys = sorted({r["key"] for r in everything})
    wanted = {0, 32767, 32768, n.SEGMENTS * 65536 - 1, keys[0], keys[-1], *keys[::7]}
    bits = n.key_bitmap(spark.createDataFrame([(k,) for k in wanted], "key int"))
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == wanted
    found = n.chains(nodes, bits)
    assert sorted(tuple(r) for r in found.drop("ring").collect()) == sorted(tuple(r) for r in everything if r["key"] in wanted)
    rings = {r["rank"]: np.array(r["ring"]).tobytes() for r in nodes.collect()}
    assert all(bytes(r["ring"]) == rings[r["rank"]] for r in found.collect())


def test_first_candidates_and_whether_there_are_more(spark):
    rings, nodes = rows_of_rings(spark)
    keyed = n.chains(nodes)
    full = n.chains(nodes, np.full(n.SEGMENTS * 8192, 255, dtype=np.uint8))
    groups = {}
    for r in sorted(keyed.collect(), key=lambda r: r["rank"]):
        groups.setdefault(r["key"], []).append((r["rank"], r["a"], r["b"]))
    apart = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count()
    bits = {(i, j): int(np.unpackbits(rings[i] ^ rings[j]).sum()) for i in range(len(rings)) for j in range(i)}
    for frame, limit in ((keyed, n.SEGMENTS * 8), (full, n.RING_BUDGET)):
        for most in (1, 3, 50):
            expected = set()
            for key, own in groups.items():
                for at, (rank, a, b) in enumerate(own):
                    heads = [h for h, x, y in own[:at] if apart(a, x) + apart(b, y) <= n.BUDGET and bits[rank, h] <= limit]
                    expected |= {(key, h, rank, k == most - 1 and len(heads) > most) for k, h in enumerate(heads[:most])}
            assert {tuple(r) for r in n._met(frame, ["key"], most).collect()} == expected
            assert any(r[3] for r in expected) == (most < 50)
        hot = frame.select("key").distinct().withColumn("blocks", F.lit(3))
        dealt = n._met(n._dealt(frame, hot), ["key", "low", "high"], 50)
        assert {(r["key"], r["head"], r["rank"]) for r in dealt.collect()} == {r[:3] for r in expected}
