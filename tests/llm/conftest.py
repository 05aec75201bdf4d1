import random

import pytest

#: Names that operators use inside; a table may have columns of these names.
INTERNAL = (
    "fp size shard words _key _text _row node _node id _id kept_node kept_id row own_text hashes bands key head least_id a b x y n o "
    "_range _piece _part _parts _start _group _large _pieces bytes rows slot law names block word_spans items spans n_words kept "
    "broken_rules payload refers_to bundle frame record_start places part mask own digest _first _digest _largest window tails statistics doc lang_pred"
).split()

LONG = " ".join(f"word{i % 700} of" for i in range(30_000))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "one two", LONG, "ünï ß 中文 ẞtraße\x00", "12 34 !!", "A\ud83dB".encode("utf-8", "replace").decode()]
    texts += [" ".join(rng.choice("alpha beta gamma delta the of".split()) for _ in range(rng.randint(3, 90))) for _ in range(30)]
    texts += ["same text the of it again"] * 20
    rows = [(i, t, "en", "src", 0) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, None, None, None, None), (None, "null id", None, "s", 1)]
    rows = [(*r, *INTERNAL) for r in rows]
    names = ", ".join(f"{c} string" for c in INTERNAL)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.where("false")

