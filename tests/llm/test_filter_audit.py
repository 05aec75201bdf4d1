import re
from itertools import permutations

from pyspark.sql import functions as F

from demandloom.llm import filter_audit as a


def brute_fails(rows):
    """Letters failed per row (doc_id, text, ...), by the contract's words."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows),
        }
        out.append("".join(f for f in "ABCDE" if fails[f]))
    return out


def brute_audit(rows, labels):
    """Every document walked through every order. rows: (doc_id, text, part); labels: (doc_id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    out, fails = {}, brute_fails(rows)
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, order, step] = (
                    len(left), len(removed), sum(f in d[1] for d in gone), sum(d[1] == f for d in mine),
                    sum(d[0] is not None and d[0] in good for d in removed), sum(d[0] is not None and d[0] in toxic for d in removed),
                )
                gone = gone + removed
        for f in "ABCDE":
            total = sum(v[1] for k, v in out.items() if k[0] == part and len(v) == 6 and k[1][k[2] - 1] == f)
            for k in [k for k in out if k[0] == part and k[1][k[2] - 1] == f]:
                out[k] += (total,)
    return out


def audited(docs, labels):
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = a.audit_filters(docs, labels).collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in found}) == len(found)
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in columns) for r in found}


def test_lehmer_ranks():
    orders = list(map("".join, permutations("ABCDE")))
    assert [a.lehmer_rank(o) for o in orders] == list(range(120))
    assert a.lehmer_rank("B") == 24 and a.lehmer_rank("BA") == 24 and a.lehmer_rank("") == 0


def test_intervals_cover_each_order_once():
    orders = list(map("".join, permutations("ABCDE")))
    for mask in range(1, 32):
        steps = [None] * 120
        for m, step, low, high in a.removal_intervals():
            if m == mask:
                for r in range(low, high):
                    assert steps[r] is None
                    steps[r] = step
        assert steps == [min(k for k, f in enumerate(o, 1) if mask >> "ABCDE".index(f) & 1) for o in orders]


def test_odd_documents(spark, odd_docs):
    """Null ids, texts and parts, repeated rows, one id with two texts, long texts, clashing columns."""
    more = [(None, "same text the of it again", None, None, 0), (12, "A B" * 40, "en", "", 0), (900, "plain words " * 30, "en", "src", 0)]
    more += [(901, " ".join(f"w{i}" for i in range(60)) + " $", "en", "other", 0), (902, " ".join(f"w{i}" for i in range(60)), "en", "other", 0)] * 3
    docs = odd_docs.unionByName(spark.createDataFrame([(*r, *odd_docs.columns[5:]) for r in more], odd_docs.schema)).withColumn("good", F.lit(1))
    labels = [(12, 1, 0), (12, 0, 1), (900, 1, None), (None, 1, 1), (902, None, 1), (5000, 1, 1), (3, 1, 1)]
    table = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int, mask int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert audited(docs, table) == brute_audit(rows, labels)


def test_masks(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want = {}
    for (i, _), f in zip(rows, brute_fails(rows)):
        key = i, sum(1 << "ABCDE".index(x) for x in f)
        want[key] = want.get(key, 0) + 1
    got = {}
    for r in a.failed_masks(odd_docs).collect():
        got[r["doc_id"], r["mask"]] = got.get((r["doc_id"], r["mask"]), 0) + r["n"]
    assert got == want


def test_empty_tables(spark, no_docs, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert a.audit_filters(no_docs, labels).collect() == []
    found = audited(odd_docs, labels)
    assert found and all(v[4] == v[5] == 0 for v in found.values())
