import random

import numpy as np
import pytest

from demandloom.llm import language_id as n
from demandloom.llm.rows import fold

WORDS = {"xx": "alo brun kest dira moven".split(), "yy": "zhir oqui wez tyx ghaa".split()}


def texts(lang, count, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 300))) for _ in range(count)]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(lang, t) for k, lang in enumerate(WORDS) for t in texts(lang, 60, k)]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(rows)] + [(900, None, "xx"), (901, "free", None), (None, "alo alo", "xx")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def plain_probabilities(net, text):
    """The network place by place, without tables or batches."""
    rows, out = n.windows_of(text), []
    for row in rows:
        pooled = []
        for places, bias in zip(net.tables, net.biases):
            answers = [sum(places[k][row[i + k]] for k in range(len(places))) for i in range(len(row) - len(places) + 1)]
            pooled += list(np.maximum(np.max(answers, axis=0) + bias, 0))
        out.append(n.softmax((np.array(pooled) @ net.out + net.out_bias)[None])[0])
    sizes = [n.WINDOW] * (len(rows) - 1) + [len(text.encode()) - n.WINDOW * (len(rows) - 1)]
    return np.average(out, axis=0, weights=sizes)


def test_learns_and_scores_like_a_plain_network(spark, labelled, odd_docs, no_docs):
    net = n.train(*n.training_windows(labelled), steps=120)
    fresh = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for k, lang in enumerate(WORDS) for t in texts(lang, 20, 50 + k))]
    found = {r["doc_id"]: r for r in n.identify(spark.createDataFrame(fresh, "doc_id long, text string, lang string"), net).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in fresh)
    for i, t, _ in fresh[:5]:
        assert abs(found[i]["score"] - plain_probabilities(net, t).max()) < 1e-4
    odd = n.identify(odd_docs, net).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    marked = {r["doc_id"]: r["lang_pred"] for r in odd if r["doc_id"] is not None}
    assert [marked[i] for i in (0, 1, 2, 7)] == ["und"] * 4 and marked[3] != "und"
    assert n.identify(no_docs, net).count() == 0


def test_gradients():
    rng = np.random.default_rng(3)
    weights = {"e": rng.normal(0, 0.5, (256, n.EMBEDDING)), "o": rng.normal(0, 0.5, (n.FILTERS * len(n.WIDTHS), 3)), "ob": np.zeros(3)}
    for w in n.WIDTHS:
        weights[f"w{w}"], weights[f"b{w}"] = rng.normal(0, 0.5, (w, n.EMBEDDING, n.FILTERS)), rng.normal(0, 0.1, n.FILTERS)
    x, y = rng.integers(0, 256, (5, 20)), np.array([0, 1, 2, 1, 0])

    def loss(ws):
        pooled = [sum(ws["e"][x][:, k : k + 21 - w] @ ws[f"w{w}"][k] for k in range(w)).max(axis=1) + ws[f"b{w}"] for w in n.WIDTHS]
        p = n.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ ws["o"] + ws["ob"])
        return -np.log(p[np.arange(5), y]).mean()

    grads = n._gradients(weights, x, y)
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(abs(g)), g.shape)
        moved = {k: v.copy() for k, v in weights.items()}
        moved[name][at] += 1e-6
        assert abs((loss(moved) - loss(weights)) / 1e-6 - g[at]) < 1e-3


def test_nothing_to_learn(spark, labelled, no_docs):
    assert n.fit_language_id(no_docs) is None
    assert {r["lang_pred"] for r in n.identify(labelled, None).collect()} == {"und"}
    only = n.train(*n.training_windows(labelled.where("lang = 'xx'")), steps=5)
    assert {r["lang_pred"] for r in n.identify(labelled.where("text is not null"), only).collect()} == {"xx"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = n.fit_language_id(docs.where(fold("doc_id", 4) != 2))
    held = docs.where((fold("doc_id", 4) == 2) & docs["lang"].isNotNull()).select("doc_id", "lang")
    joined = held.join(n.identify(docs, net), "doc_id")
    assert joined.where("lang = lang_pred").count() >= 0.95 * joined.count()


def test_repeated_rows_and_ids_leave_every_language_its_windows(spark):
    """A language under three ids, one without ids, and one that is a single row many times."""
    rows = [(i % 3, f"english text number {i}", "en") for i in range(5000)] + [(None, f"deutscher satz {i}", "de") for i in range(5000)]
    rows += [(9, "une seule ligne", "fr")] * 5000 + [(100 + i, f"linea numero {i}", "es") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    windows, labels, languages = n.training_windows(docs, most=400)
    counts = dict(zip(languages, np.bincount(labels)))
    assert counts["fr"] == 1 and counts["es"] == 40
    assert 60 <= counts["en"] <= 150 and 60 <= counts["de"] <= 150
