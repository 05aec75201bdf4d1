import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandloom.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_cached_ids_equal_the_tokenizer(spark, odd_docs, sf_dir, monkeypatch):
    whole, cached = Tokenizer.from_file(PATH), p.CachedTokenizer(PATH)
    monkeypatch.setattr(p, "CACHE_BYTES", 60_000)
    texts = [r["text"] or "" for r in odd_docs.collect()] + [
        r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()
    ]
    texts += ["It's don't I'LL x's'", "a<|endoftext|>b <|startoftext|>", "é Å ẞ İ ΑΣ", "tab\tx\x0by z w\x1c\x85q", "a1b2 c_d ___ (x) \"y\". ½ ²", "\x00\x01 ﻿", "ﬁ ﬂ 가각 각"]
    for text in texts:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        assert cached.ids(text) == ids.tobytes(), text[:50]


def test_least_squares_keeps_its_conditions():
    rng = np.random.default_rng(6)
    for _ in range(20):
        a, b = rng.random((8, 15)), rng.random(8) * 9 - 2
        x = p.non_negative_least_squares(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and gain.max() < 1e-6 and abs(gain[x > 0]).max(initial=0) < 1e-6


def test_combinations_are_all():
    bins = [1, 2, 3, 5, 8, 12, 16]
    want = {(x,) for x in bins if x == 16} | {(x, y) for x in bins for y in bins if x >= y and x + y == 16}
    want |= {(x, y, z) for x in bins for y in bins for z in bins if x >= y >= z and x + y + z == 16}
    got = p.combinations(bins, 16)
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("spread", [(1, 2047), (1500, 1500), (20, 20), (1024, 1024), (2047, 2047), (1, 1)])
def test_remainders_are_whole_and_fit(spread):
    rng = random.Random(7)
    lengths = [rng.randint(*spread) for _ in range(700)]
    pieces, used = p.pack_remainders(lengths)
    covered, filled = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        covered[doc].append((start, length))
        filled[sequence].append((offset, length))
    for doc, length in enumerate(lengths):
        assert contiguous(covered[doc]) == length
    sums = [contiguous(own) for own in filled.values()]
    assert len(sums) == used and max(sums) <= p.WINDOW
    padding = sum(0 if s & (s - 1) == 0 else p.WINDOW - s for s in sums)
    assert padding <= 0.02 * sum(lengths)


def contiguous(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at and length > 0
        at += length
    return at


def test_query_rows(spark, odd_docs, no_docs):
    whole = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect() if r["doc_id"] is not None}
    rows = p.pack_documents(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(3), PATH).collect()
    docs, sequences, sizes = defaultdict(list), defaultdict(list), {}
    for r in rows:
        ids = np.array([*whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1], dtype="<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        docs[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        sizes[r["doc_id"]] = r["doc_tokens"]
    assert {doc: contiguous(spans) for doc, spans in docs.items()} == sizes and set(sizes) == set(texts)
    assert all(contiguous(s) <= 2048 for s in sequences.values())
    assert p.pack_documents(odd_docs, PATH).where("start = 0").count() == odd_docs.count()
    assert p.pack_documents(no_docs, PATH).count() == 0


def test_cache_holds_bounded_bytes():
    """Whole paragraphs without a blank are no pieces worth keeping."""
    cached, rng = p.CachedTokenizer(PATH), random.Random(1)
    for _ in range(300):
        cached.ids("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(500)) + " ab")
    assert len(cached.pieces) < 10 and cached.held < 5_000
    for k in range(3):
        cached.ids(" ".join(f"w{k}x{i}" for i in range(200_000)))
    assert cached.held <= p.CACHE_BYTES + 200_000 * 3 * p.ENTRY_BYTES
