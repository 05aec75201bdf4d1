import random
import re

from demandloom.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {p + k for at in places.values() if len(at) > 1 for p in at for k in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def test_statistics_equal_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b ", "c\n", " ", "\t", "\x1c", "|", "é", "\x0b"]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in q.judge(docs).collect():
        want = brute(texts[r["doc_id"]])
        assert tuple(r)[1:7] == want, (texts[r["doc_id"]], want)
        assert not (r["base_failed"] and r["kept"])
        assert r["kept"] == (not r["broken_rules"])
    rows = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    for r in q.judge(odd_docs).where("doc_id is not null").collect():
        assert tuple(r)[1:7] == brute(rows[r["doc_id"]])
    assert q.judge(odd_docs).count() == odd_docs.count()
    assert q.passing(odd_docs).columns == odd_docs.columns
    assert q.passing(odd_docs).count() == q.judge(odd_docs).where("kept").count()
    assert q.judge(no_docs).count() == q.passing(no_docs).count() == 0


def test_rules_keep_prose_and_reject_junk(spark):
    prose = " ".join(f"the fox{i} of" for i in range(30))
    texts = [prose, " ".join(f"w{i}###" for i in range(99)), prose + "\n" + "\n".join(["line of it"] * 9), " ".join(f"W{i}!!" for i in range(80))]
    kept = {r["doc_id"]: r["broken_rules"] for r in q.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept[0] == [] and "symbols_per_word" in kept[1] and "repeated_lines" in kept[2] and "marks_per_word" in kept[3]


def test_no_user_functions(spark, odd_docs):
    plan = q.judge(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Exchange"))


def test_statistics_are_worked_out_once(spark, odd_docs):
    """A filter on the verdict must not repeat the statistics: one split of words, one of lines."""
    for rows in (q.passing(odd_docs), q.judge(odd_docs).where("kept")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") == 2 and plan.count("sort_array(") == 1
