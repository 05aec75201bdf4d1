import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from demandloom.llm import decontamination, secret_scan


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus with one case of each kind, and the rows it must end with."""
    rng = random.Random(12)
    words = "the of and to in is that was for on with as by at from stone river light over walks".split()
    say = lambda n: " ".join(rng.choice(words) + str(rng.randrange(900)) + " the of" for _ in range(n))
    passage = " ".join(f"item{i}" for i in range(20))
    clean = [say(60) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100 + i, t) for i, t in enumerate(clean[:5])] + [(200, clean[6] + " tail")]
    rows += [(300, say(40) + " " + passage + " " + say(30)), (301, say(50) + ' token = "c80fd45a66f8564ae70609f7b2a26100" ' + say(20))]
    rows += [(400, "short"), (401, None), (402, "Ha " * 90), (403, "### ".join(say(60).split()))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_take_effect(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = lambda name: {r[0] for r in seen[name].select("doc_id").collect()}
    prose = {*range(20), 300, 301}
    assert ids("quality rules") == prose | {*range(100, 105), 200}
    assert ids("near duplicates") == ids("decontamination") == ids("secrets") == ids("packing") == prose
    texts = {r["doc_id"]: r for r in seen["secrets"].collect()}
    assert "item5" not in texts[300]["text"] and "[SECRET]" in texts[301]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())
    assert not any(secret_scan.spans_of(r["text"])[0] for r in texts.values())
    phrases = decontamination.Phrases([(["7"], " ".join(f"item{i}" for i in range(20)))], 10)
    assert not any(decontamination.shard_hits([r["text"] for r in texts.values()], phrases)[1])
    whole = corpus_pipeline.run(spark, corpus)
    assert sorted(whole.select("doc_id", "start", "doc_tokens").collect()) == sorted(seen["packing"].select("doc_id", "start", "doc_tokens").collect())


def test_no_documents(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names}
