import random

import public_tokenizers
import pytest

from demandloom.llm import token_counts as t

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, scores, byte_score):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * byte_score, best[end - 1][1] + size)]
        for start in range(end):
            if word[start:end] in scores:
                options.append((best[start][0] + scores[word[start:end]], best[start][1] + 1))
        best.append(max(options, key=lambda o: (o[0], -o[1])))
    return best[-1][1]


@pytest.fixture(scope="module")
def scores():
    return t.piece_scores(PATH)


def test_counts_equal_forward_scores_of_each_word(spark, scores, odd_docs, no_docs, sf_dir):
    sample = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40)
    for docs in (sample, odd_docs.where("doc_id is not null").select("doc_id", "text")):
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        for r in t.count_tokens(docs, PATH).collect():
            words = texts[r["doc_id"]].split()
            known = {w: brute(t.SPACE + w, *scores) for w in set(words)}
            assert (r["n_pretokens"], r["n_tokens"]) == (len(words), sum(known[w] for w in words))
    assert t.count_tokens(odd_docs, PATH).count() == odd_docs.count()
    assert t.count_tokens(no_docs, PATH).count() == 0


def test_a_full_trie_starts_anew(scores, monkeypatch):
    words = "alpha alphabet beta better alpine 中文 alpha".split()
    whole = t.CountingTrie(*scores)
    want = [whole.count(w) for w in words]
    monkeypatch.setattr(t, "MOST_NODES", 3)
    small = t.CountingTrie(*scores)
    assert [small.count(w) for w in words] == want
    assert len(small.best) < len(whole.best)
    assert small.total(words) == whole.total(words) == sum(want)


def test_long_words_leave_no_nodes(scores, monkeypatch):
    """The rolling window gives the trie's counts, and a word of any length holds a bounded part of itself."""
    rng = random.Random(12)
    words = ["".join(rng.choice(["a", "ing", "the", "ß", "中", "国", "zq", "▁"]) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    trie, plain = t.CountingTrie(*scores), t.CountingTrie(*scores)
    monkeypatch.setattr(t, "LONG_WORD", 10)
    rolled = [trie.count(w) for w in words]
    monkeypatch.setattr(t, "LONG_WORD", 10**9)
    assert rolled == [plain.count(w) for w in words] == [brute(t.SPACE + w, *scores) for w in words]
    monkeypatch.setattr(t, "LONG_WORD", 256)
    nodes = len(trie.best)
    assert trie.count("中" * 200_000) > 0 and len(trie.best) == nodes
