import hashlib
import random

from demandloom.llm import decontamination as d


def brute(text, items, window=d.WINDOW):
    words, hit, found = d.words_of(text), set(), set()
    for item, phrase in items:
        own = d.words_of(phrase or "")
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[k : k + size]:
                    hit.update(range(p, p + size))
                    found.add("" if item is None else str(item))
    return len(words), hit, found


def test_index_equals_scan():
    rng = random.Random(3)
    for _ in range(200):
        names = [f"w{i}" for i in range(rng.choice([2, 3, 6]))]
        say = lambda n: " ".join(rng.choice(names) for _ in range(n))
        items = [(i, say(rng.choice([0, 1, 2, 3, 4, 6]))) for i in range(4)]
        texts = [say(rng.choice([0, 1, 3, 10, 40])).replace("w0", rng.choice(["zz", "w0"])) for _ in range(6)]
        for text, n, spans, found in zip(texts, *d.shard_hits(texts, d.Phrases([([str(i)], t) for i, t in items], 4))):
            want = brute(text, items, 4)
            assert (n, {w for a, b in spans for w in range(a, b)}, found) == want


def test_query_columns_blocks_and_repeats(spark, odd_docs, no_docs):
    passage = " ".join(f"Q{i}" for i in range(14))
    items = [(1, passage), (10, "tiny item"), (2, None), (3, ""), (1, passage), (11, "same text the of it again"), (None, "tiny item"), (77, passage)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [f"x {passage.lower()} y", "x " + passage[: passage.index(" Q9")], "a tiny  ITEM!", None, "", "tiny\nitem tiny item"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (d.BLOCK_BYTES, 40):
        rows = d.contamination_digest(d.contamination_spans(docs, bench, block_bytes=block)).collect()
        assert len(rows) == len(texts)
        for r in rows:
            n, hit, found = brute(texts[r["doc_id"]] or "", items)
            digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            assert tuple(r)[1:] == (n, len(hit), len(found), digest, bool(hit))
    assert d.contamination_spans(odd_docs, bench).count() == odd_docs.count()
    assert d.contamination_spans(no_docs, bench).count() == 0
    assert d.contamination_digest(d.contamination_spans(docs, bench.where("false"))).where("contaminated").count() == 0


def test_removal(spark, odd_docs, no_docs):
    passage = " ".join(f"q{i}" for i in range(12))
    halves = passage.split(" ")
    nested = " ".join([*halves[:6], *halves, *halves[6:]])  # what remains after one removal is the passage again
    docs = spark.createDataFrame(
        [(0, f"Start {passage}, end."), (1, passage), (2, None), (3, f"A {nested} B"), (4, "clean")], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    for block in (d.BLOCK_BYTES, 5):
        rows = {r[0]: r[1] for r in d.remove_contamination(docs, bench, block_bytes=block).collect()}
        assert rows == {0: "Start \n, end.", 2: None, 3: "A \n B", 4: "clean"}
    assert d.remove_contamination(odd_docs, bench).columns == odd_docs.columns
    assert d.remove_contamination(no_docs, bench).count() == 0


def test_block_size_and_order_change_nothing(spark):
    """Items that come together only when others are cut, in blocks of every size."""
    rng = random.Random(8)
    a, b, c = ([f"{x}{i}" for i in range(10)] for x in "abc")
    texts = [" ".join([*a[:5], *b, *a[5:]]), " ".join([*b[:3], *a[:5], *c, *a[5:], *b[3:]]), " ".join([*c[:5], "stay", *c[5:]]), None, "clean"]
    for _ in range(40):
        text = [f"x{i}" for i in range(3)]
        for _ in range(4):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice([a, b, c, a[:5], c[5:]])
        texts.append(" ".join(text))
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, row int")
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    results = []
    for rows in (items, items[::-1]):
        bench = spark.createDataFrame(rows, "item_id long, text string").coalesce(1)
        for block in (1, 40, 80, d.BLOCK_BYTES):
            kept = d.remove_contamination(docs, bench, block_bytes=block)
            results.append(sorted(map(str, kept.collect())))
            assert all(not brute(r["text"] or "", items)[1] for r in kept.collect())
    assert all(r == results[0] for r in results) and "doc_id=0" not in results[0][0]


def test_equal_items_are_one_phrase(spark):
    """A third of the benchmark may be one text; names go together, and no block grows with copies."""
    bench = spark.createDataFrame([(i, "one hot text") for i in range(500)] + [(900 + i, f"text {i}") for i in range(9)], "item_id long, text string")
    blocks = [block() for block in d.phrase_blocks(bench, "item_id", "text", 30)]
    assert sum(len(b) for b in blocks) == 10 and len(blocks) > 3
    assert max(sum(len(t) + len(",".join(n)) for n, t in b if t != "one hot text") for b in blocks) <= 30 + 20
    assert [len(n) for b in blocks for n, t in b if t == "one hot text"] == [500]
