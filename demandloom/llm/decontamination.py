"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded stretch of a partition's documents. Only words of the benchmark
can be part of a window, so the shard's index holds the runs of such words that are
long enough for a window; other words end a run. All windows are searched backwards
at once, their occurrences located from sampled places, and spans merged per document.
No document leaves its task, so copies and hot sources cost no more than other rows.

The benchmark is the stated query set. Items with equal texts are one phrase with several
names; phrases are read in blocks of bounded size, and each block is broadcast for one
pass over the documents, which hands its spans to the next pass. Texts are cut only when
all blocks have been searched, and cut texts are searched again by all blocks, so results
are the same for any block size.
"""

import re
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import stored_in_order, with_running
from ..session import shared_folder
from .fm_index import FMIndex
from .rows import map_slices, row_and_text

WINDOW = 10
#: Words in a shard's index are at most these plus one slice of documents.
SHARD_WORDS = 1_500_000
#: UTF-8 bytes of benchmark texts and names in one broadcast, plus those of one text at most.
BLOCK_BYTES = 16 << 20

# The word pattern of the contract, as characters of a text and as a table over UTF-8 bytes.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def words_of(text):
    return text.encode("utf-8", "surrogatepass").translate(BYTES).split()


def word_places(text):
    return [m.span() for m in WORD.finditer(text.translate(LOWER))]


class Phrases:
    """The windows of a block of (names, text): symbols of words, and by length a matrix of windows."""

    def __init__(self, items, window):
        self.symbols, found = {}, {}
        for names, text in items:
            ids = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if ids else 0):
                found.setdefault(size, {}).setdefault(tuple(ids[k : k + size]), set()).update(names)
        self.by_length = {
            size: (np.array(list(windows), dtype=np.int64), [sorted(s) for s in windows.values()])
            for size, windows in found.items()
        }
        self.least = min(self.by_length, default=0)

    def occurrences(self, symbols, starts):
        """(place, length, items) of every window in documents laid end to end.

        ``starts`` are the documents' first places; a window never crosses them.
        """
        known = symbols > 0
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        inner = starts[(starts > 0) & (starts < len(symbols))]
        opens[inner] |= known[inner]
        run = np.cumsum(opens)
        lengths = np.bincount(run[known], minlength=int(run[-1]) + 1 if len(run) else 1)
        places = np.flatnonzero(known & (lengths[run] >= self.least))
        if not len(places):
            return
        # A mark after each run: places shift by the runs before them.
        first = opens[places]
        shift = np.cumsum(first) - 1
        text = np.zeros(len(places) + int(shift[-1]) + 1, dtype=np.int64)
        origin = np.full(len(text), -1, dtype=np.int64)
        text[np.arange(len(places)) + shift] = symbols[places]
        origin[np.arange(len(places)) + shift] = places
        index = FMIndex(text, len(self.symbols) + 1)
        for size, (windows, items) in self.by_length.items():
            low, high = index.search(windows)
            hits = np.flatnonzero(high > low)
            counts = (high - low)[hits]
            total = int(counts.sum())
            if total:
                within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
                at = origin[index.locate(np.repeat(low[hits], counts) + within)]
                yield at, size, np.repeat(hits, counts), items


def merged(spans):
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def shard_hits(texts, phrases):
    """Per text: number of words, merged word spans [start, end), set of items."""
    get = phrases.symbols.get
    ids = [np.fromiter(map(get, w, repeat(0)), dtype=np.int64, count=len(w)) for w in map(words_of, texts)]
    sizes = np.array([len(v) for v in ids], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    spans, items = [[] for _ in texts], [set() for _ in texts]
    symbols = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
    if len(symbols) and phrases.by_length:
        for at, size, windows, names in phrases.occurrences(symbols, starts[:-1]):
            docs = np.searchsorted(starts, at, side="right") - 1
            order = np.lexsort((at, docs))
            docs, at, windows = docs[order], at[order], windows[order]
            cut = np.flatnonzero(np.diff(docs)) + 1
            for d, a, w in zip(docs[np.r_[0, cut]], np.split(at - starts[docs], cut), np.split(windows, cut)):
                gaps = np.flatnonzero(np.diff(a) > size) + 1
                heads, tails = a[np.r_[0, gaps]], a[np.r_[gaps - 1, len(a) - 1]] + size
                spans[d] += zip(heads.tolist(), tails.tolist())
                for k in np.unique(w):
                    items[d].update(names[k])
    return sizes.tolist(), [merged(s) for s in spans], items


def removed(text, spans):
    """The text without its word spans; a line break stands where a span was."""
    places = word_places(text)
    out, at = [], 0
    for start, end in spans:
        out += [text[at : places[start][0]], "\n"]
        at = places[end - 1][1]
    return "".join(out) + text[at:]


def shards(slices, words=SHARD_WORDS):
    """Lists of slices with about ``words`` words in all, by a bound on bytes."""
    held, size = [], 0
    for batch in slices:
        held.append(batch)
        size += batch.nbytes
        if size >= words * 6:
            yield held
            held, size = [], 0
    if held:
        yield held


def phrase_blocks(benchmark, item_col, text_col, block_bytes):
    """(names, text) of all items in blocks, as functions that fetch one block each.

    Running sizes place the phrases, so no block holds more than ``block_bytes`` and one
    phrase. A null text has no windows; a null id is the empty name.
    """
    name = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    rows = (
        benchmark.select(name.alias("name"), F.col(text_col).alias("text"))
        .where("text is not null")
        .groupBy("text")
        .agg(F.sort_array(F.collect_set("name")).alias("names"))
        .withColumn("size", F.octet_length("text") + F.octet_length(F.array_join("names", ",")))
    )
    stored = stored_in_order(rows, "text")
    total = stored.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if total <= block_bytes:
        return [lambda: [(r["names"], r["text"]) for r in stored.collect()]]
    placed = with_running(stored, ["text"], ["size"]).withColumn("block", F.floor(F.col("_before_size") / block_bytes))
    numbers = [r[0] for r in placed.select("block").distinct().orderBy("block").collect()]
    return [lambda k=k: [(r["names"], r["text"]) for r in placed.where(F.col("block") == k).collect()] for k in numbers]


def _stored(frame):
    path = shared_folder(frame.sparkSession, "decontamination")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


SPAN_DDL = "n_words long, word_spans array<struct<start: int, end: int>>, items array<string>"


def _searched(frame, blocks, window, columns, store=True):
    """``frame`` with the words, merged spans and names found by all blocks.

    ``frame`` has a column ``text`` and those of ``columns``, a schema text, which pass unchanged.
    The frame is stored between blocks, and behind the last one if ``store``.
    """
    context = frame.sparkSession.sparkContext

    def step(frame, phrases):
        def work(slices):
            for held in shards(slices):
                texts = [t or "" for b in held for t in b.column("text").to_pylist()]
                sizes, spans, items = shard_hits(texts, phrases.value)
                if "items" in held[0].schema.names:
                    old_spans = [v for b in held for v in b.column("word_spans").to_pylist()]
                    old_items = [v for b in held for v in b.column("items").to_pylist()]
                    spans = [merged([*map(tuple, s), *((o["start"], o["end"]) for o in old)]) for s, old in zip(spans, old_spans)]
                    items = [i.union(old) for i, old in zip(items, old_items)]
                table = pa.Table.from_batches(held)
                yield {
                    **{c: table[c].combine_chunks() for c in passed},
                    "n_words": sizes,
                    "word_spans": [[{"start": a, "end": b} for a, b in s] for s in spans],
                    "items": [sorted(i) for i in items],
                }

        passed = [c for c in frame.columns if c not in ("n_words", "word_spans", "items")]
        return map_slices(frame, work, f"{columns}, text string, {SPAN_DDL}")

    for k, block in enumerate(blocks):
        frame = step(frame, context.broadcast(Phrases(block(), window)))
        if store or k + 1 < len(blocks):
            frame = _stored(frame)
    return frame


def contamination_spans(
    docs, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    window=WINDOW, block_bytes=BLOCK_BYTES,
):
    """One row per document: doc_id, n_words, merged word spans of windows, items found.

    A null text has no words, a null item text no windows, a null item id is the empty
    name. Repeated rows stay repeated. Other columns of either table are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = phrase_blocks(benchmark, item_col, item_text_col, block_bytes)
    return _searched(frame, blocks, window, f"doc_id {kind}", store=False).drop("text")


def remove_contamination(
    docs, benchmark, text_col="text", item_col="item_id", item_text_col="text", window=WINDOW, block_bytes=BLOCK_BYTES
):
    """``docs`` without the benchmark's windows; documents left without a word go.

    A removal can bring the ends of a window together. All windows found in a text are cut
    at once, and cut texts are searched again for the whole benchmark until nothing is found,
    so the result hangs neither on the size nor on the order of blocks. Null texts and texts
    without a hit stay as they are; null item texts and items without a word cut nothing;
    repeated rows are cut each for itself; other columns pass unchanged.
    """
    frame, columns, back = row_and_text(docs, text_col)
    blocks = phrase_blocks(benchmark, item_col, item_text_col, block_bytes)
    if len(blocks) == 1:
        rounds = [_cut_to_the_end(frame, docs.sparkSession.sparkContext.broadcast(Phrases(blocks[0](), window)), columns)]
    else:
        rounds = []
        while True:
            found = _searched(frame, blocks, window, columns)
            rounds.append(found.where(F.size("word_spans") == 0).select("row", "text"))
            frame = _stored(_cut(found.where(F.size("word_spans") > 0), columns))
            if frame.isEmpty():
                break
    return back(reduce(DataFrame.union, rounds))


def _kept_rows(held, texts, gone):
    """Rows of some slices with new texts, without those whose places are in ``gone``."""
    row = pa.Table.from_batches(held)["row"].combine_chunks()
    left = [i for i in range(len(texts)) if i not in gone]
    return {"row": row.take(pa.array(left, type=pa.int64())), "text": [texts[i] for i in left]}


def _cut(found, columns):
    """One cut of every text by its spans."""

    def work(slices):
        for batch in slices:
            spans = [[(s["start"], s["end"]) for s in own] for own in batch.column("word_spans").to_pylist()]
            texts = [*map(removed, batch.column("text").to_pylist(), spans)]
            yield _kept_rows([batch], texts, {i for i, t in enumerate(texts) if not words_of(t)})

    return map_slices(found.select("row", "text", "word_spans"), work, f"{columns}, text string")


def _cut_to_the_end(frame, phrases, columns):
    """All cuts of every text in one pass, where one block holds the whole benchmark."""

    def work(slices):
        for held in shards(slices):
            texts = [t for b in held for t in b.column("text").to_pylist()]
            todo, gone = list(range(len(texts))), set()
            while todo:
                _, spans, _ = shard_hits([texts[i] or "" for i in todo], phrases.value)
                todo = [(i, s) for i, s in zip(todo, spans) if s]
                for i, s in todo:
                    texts[i] = removed(texts[i], s)
                    if not words_of(texts[i]):
                        gone.add(i)
                todo = [i for i, _ in todo if i not in gone]
            yield _kept_rows(held, texts, gone)

    return map_slices(frame, work, f"{columns}, text string")


def contamination_digest(spans):
    """Counts and a digest from the rows of ``contamination_spans``."""
    hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return spans.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("word_spans") > 0).alias("contaminated"),
    )
