import random
import re

import numpy as np
import pytest
import xxhash

from demandloom.llm import simhash as s


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Least id reachable, by comparing everything with everything. fps: [(id, fp)]."""
    root = {fp: fp for _, fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = sorted(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, fp in fps:
        if i is not None:
            r = find(fp)
            least[r] = min(least.get(r, i), i)
    return {i: least[find(fp)] for i, fp in fps if i is not None}


def test_fingerprints(spark, odd_docs):
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    for r in s.fingerprints(odd_docs).where("doc_id is not null").collect():
        assert r["fp"] % 2**64 == brute_fingerprint(texts[r["doc_id"]])


def test_every_close_pair_shares_a_passing_key():
    rng = random.Random(8)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            b ^= 1 << bit
        a_, b_ = (np.array([x], dtype="<u8") for x in (a, b))
        passed = [k for k in range(8) if s.chained(a_, b_, k)[0, 0]]
        assert bool(passed) == ((a ^ b).bit_count() <= 3)
        for k in passed:
            parts = [(a ^ b) >> (8 * ((k + j) % 8)) & 255 for j in range(5)]
            assert parts[0] == parts[1] == 0 and sum(p != 0 for p in parts[2:]) <= 1


@pytest.mark.parametrize("block", [s.KEY_BLOCK, 6])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(s, "KEY_BLOCK", block)
    rng = random.Random(9)
    fps, x = [], rng.getrandbits(64)
    for _ in range(40):  # a long chain, each three bits from the next
        for bit in rng.sample(range(64), 3):
            x ^= 1 << bit
        fps.append(x)
    centre = rng.getrandbits(64)
    fps += [centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]  # a large group of near copies
    fps += [rng.getrandbits(64) for _ in range(100)] + [0, 0, 1 << 63, 7, 15 << 60]
    rng.shuffle(fps)
    rows = list(enumerate(fps))
    nodes = spark.createDataFrame([(s.signed(f),) for f in set(fps)], "fp long")
    roots = {r["fp"] % 2**64: r["root"] % 2**64 for r in s.least_reachable(s.key_links(s.chain_keys(nodes))).collect()}
    least = {}
    for i, fp in rows:
        r = roots.get(fp, fp)
        least[r] = min(least.get(r, i), i)
    assert {i: least[roots.get(fp, fp)] for i, fp in rows} == brute_components(rows)


def test_documents(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        found = s.near_duplicates(docs).collect()
        want = brute_components([(r["doc_id"], r["fp"] % 2**64) for r in found])
        assert {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None} == want
        assert len(found) == docs.count()
        kept = s.keep_one(docs)
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.collect()]
        assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert s.near_duplicates(no_docs).count() == s.keep_one(no_docs).count() == 0
