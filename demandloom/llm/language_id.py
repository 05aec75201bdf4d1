"""Language identification by a small convolutional network over bytes.

Filters of several widths run over fixed windows of a text's bytes; each filter keeps
its largest answer, and a softmax over those gives the languages. Training is plain
numpy on a bounded sample of labelled windows. For prediction the byte embedding and the
filters fold into one table per filter place, so a convolution is a sum of table rows.
Every byte of a text is read; a document's answer is the mean over its windows.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from .rows import map_slices, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
#: Documents that a fit reads at most, shared out evenly over the languages.
FIT_DOCS = 3000
#: Windows that a document gives to the fit at most.
FIT_WINDOWS = 6
STEPS = 400
BATCH = 192
RATE = 0.01
SEED = 7
UNKNOWN = "und"
#: Windows of a prediction held at once.
PREDICTED = 96


def windows_of(text, window=WINDOW):
    """All bytes of a text as rows of ``window`` bytes, the last one filled with zeros."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(max(1, -(-len(data) // window)) * window, dtype=np.uint8)
    out[: len(data)] = data
    return out.reshape(-1, window)


@dataclass
class ByteNetwork:
    """Folded tables per width and place, biases, and the softmax layer."""

    languages: list
    tables: list
    biases: list
    out: np.ndarray
    out_bias: np.ndarray

    def probabilities(self, windows):
        return np.concatenate([self._block(windows[i : i + PREDICTED]) for i in range(0, len(windows), PREDICTED)])

    def _block(self, windows):
        at = windows.astype(np.intp)
        pooled = []
        for places, bias in zip(self.tables, self.biases):
            n = at.shape[1] - len(places) + 1
            total = places[0].take(at[:, :n], axis=0)
            for k in range(1, len(places)):
                total += places[k].take(at[:, k : k + n], axis=0)
            pooled.append(np.maximum(total.max(axis=1) + bias, 0))
        return softmax(np.concatenate(pooled, axis=1) @ self.out + self.out_bias)


def softmax(x):
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows, labels, languages, steps=STEPS, seed=SEED):
    """Fit by Adam on windows (n x bytes) and label numbers; the classes are weighted evenly."""
    rng = np.random.default_rng(seed)
    weights = {"e": rng.normal(0, 0.3, (256, EMBEDDING)), "o": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages)))}
    weights["ob"] = np.zeros(len(languages))
    for w in WIDTHS:
        weights[f"w{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS))
        weights[f"b{w}"] = np.zeros(FILTERS)
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    by_label = [np.flatnonzero(labels == k) for k in range(len(languages))]
    per = max(1, BATCH // max(1, len(languages)))
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(own, per) for own in by_label])
        x, y = windows[rows].astype(np.intp), labels[rows]
        grads = _gradients(weights, x, y)
        rate = RATE * (1 - (step - 1) / steps)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    tables = [
        [np.ascontiguousarray(weights["e"] @ weights[f"w{w}"][k], dtype=np.float32) for k in range(w)] for w in WIDTHS
    ]
    return ByteNetwork(list(languages), tables, [weights[f"b{w}"] for w in WIDTHS], weights["o"], weights["ob"])


def _gradients(weights, x, y):
    embedded = weights["e"][x]
    pooled, peaks = [], []
    for w in WIDTHS:
        n = x.shape[1] - w + 1
        total = sum(embedded[:, k : k + n] @ weights[f"w{w}"][k] for k in range(w))
        peak = total.argmax(axis=1)
        pooled.append(np.take_along_axis(total, peak[:, None, :], axis=1)[:, 0] + weights[f"b{w}"])
        peaks.append(peak)
    raw = np.concatenate(pooled, axis=1)
    active = np.maximum(raw, 0)
    error = softmax(active @ weights["o"] + weights["ob"])
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    grads = {"o": active.T @ error, "ob": error.sum(axis=0), "e": np.zeros_like(weights["e"])}
    back = (error @ weights["o"].T) * (raw > 0)
    rows = np.arange(len(x))[:, None]
    for i, (w, peak) in enumerate(zip(WIDTHS, peaks)):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        grads[f"b{w}"] = g.sum(axis=0)
        own = np.zeros_like(weights[f"w{w}"])
        for k in range(w):
            bytes_at = x[rows, peak + k]
            own[k] = np.einsum("bfe,bf->ef", weights["e"][bytes_at], g)
            np.add.at(grads["e"], bytes_at, g[:, :, None] * weights[f"w{w}"][k].T[None])
        grads[f"w{w}"] = own
    return grads


def training_windows(docs, id_col="doc_id", text_col="text", label_col="lang", most=FIT_DOCS, per_doc=FIT_WINDOWS):
    """Windows and labels of at most about ``most`` documents, evenly over the languages.

    Documents are picked by a hash of id and text with the share that a language's number of
    different documents allows, and repeated rows are one document: neither one id for many
    texts nor one row a million times fills or empties a language's share. A picked document
    gives evenly spread windows. Only these reach the driver.
    """
    known = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("doc")
    )
    counts = {r[0]: r[1] for r in known.groupBy("lang").agg(F.approx_count_distinct("doc", 0.02)).collect()}
    languages = sorted(counts)
    if not languages:
        return np.zeros((0, WINDOW), dtype=np.uint8), np.zeros(0, dtype=np.int64), []
    share = most / len(languages)
    draw = F.pmod(F.xxhash64("doc", F.lit("fit")), F.lit(1 << 20)) / (1 << 20)
    wanted = F.lit(False)
    for lang, n in counts.items():
        wanted = wanted | ((F.col("lang") == lang) & (draw < share / max(n, 1)))
    picked = known.where(wanted).groupBy("lang", "doc").agg(F.first("text").alias("text"))

    def work(slices):
        for batch in slices:
            langs, texts = texts_of(batch, 0, 1)
            out = {"lang": [], "bytes": []}
            for lang, text in zip(langs, texts):
                rows = windows_of(text)
                at = np.unique(np.linspace(0, len(rows) - 1, per_doc).astype(int))
                out["lang"] += [lang] * len(at)
                out["bytes"] += [rows[i].tobytes() for i in at]
            yield out

    found = map_slices(picked.select("lang", "text"), work, "lang string, bytes binary").toArrow()
    number = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([number[v] for v in found["lang"].to_pylist()], dtype=np.int64)
    rows = np.frombuffer(b"".join(found["bytes"].to_pylist()), dtype=np.uint8).reshape(-1, WINDOW)
    seen = np.unique(labels)  # a language whose few documents were not picked cannot be learned
    order = np.lexsort((*rows.T[:8][::-1], labels))
    return rows[order], np.searchsorted(seen, labels[order]), [languages[k] for k in seen]


def fit_language_id(docs, id_col="doc_id", text_col="text", label_col="lang", **bounds):
    return train_or_none(*training_windows(docs, id_col, text_col, label_col, **bounds))


def train_or_none(windows, labels, languages):
    return train(windows, labels, languages) if languages else None


def identify(docs, network, id_col="doc_id", text_col="text"):
    """doc_id, lang_pred and score of every row of ``docs``.

    A null text, a text without a letter, and any text under a network that learned
    nothing give ``und`` with score 0. The score is the mean probability over all bytes.
    Ties go to the first language in order. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few hundred kB, whatever the input

    def work(slices):
        network = shared.value
        for batch in slices:
            ids, texts = texts_of(batch, 0, 1)
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if network and any(map(str.isalpha, t))]
            for i in known:
                rows = windows_of(texts[i])
                size = len(texts[i].encode("utf-8", "surrogatepass"))
                share = np.full(len(rows), WINDOW, dtype=np.float64)
                share[-1] = size - WINDOW * (len(rows) - 1)
                mean = (network.probabilities(rows) * share[:, None]).sum(axis=0) / size
                best = int(mean.argmax())
                langs[i], scores[i] = network.languages[best], float(min(1.0, mean[best]))
            yield {"doc_id": ids, "lang_pred": langs, "score": scores}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs.select(id_col, text_col), work, f"doc_id {kind}, lang_pred string, score double")
