"""Packing of documents into sequences of 2048 tokens by non-negative least squares.

A partition is packed in blocks of bounded size, each in the task that tokenized it, so
no id is ever shuffled. Full windows of a document are sequences of their own. For the
remainders of a block, all shallow combinations of length bins that fill a window are
enumerated; non-negative least squares finds how often to use each, so that the uses add
up to the histogram of bins; the counts are rounded down and applied. What remains is
packed greedily, one after the other, cut at the window's end. The last, unfilled window
of a block is cut into powers of two, which need no padding.
"""

import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import functions as F

from .rows import map_slices, texts_of

WINDOW = 2048
END_ID = 1
#: Remainders are counted in bins of so many tokens, rounded up.
BIN = 16
DEPTH = 3
#: A block ends when its remainders reach either bound.
BLOCK_TOKENS = 4_000_000
BLOCK_DOCS = 100_000
#: Bytes that a worker's kept pieces and their ids take at most; beyond it the cache starts anew.
CACHE_BYTES = 160 << 20
#: Longer pieces are seldom met again and not kept.
CACHED_LENGTH = 64
#: Bytes that an entry takes besides its texts, roughly.
ENTRY_BYTES = 200

# Letters and marks for which lower case, composition and the parting into pre-tokens are plain.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")


def byte_letters():
    """The printable character that byte-level tokenizers write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class CachedTokenizer:
    """Ids of texts as little-endian 32-bit bytes, kept per white-space piece.

    No pre-token of this vocabulary crosses a blank, so a text's ids are those of its
    pieces one after the other. Plain words go straight to the model; any other piece
    takes the tokenizer's whole way.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.clear()

    def clear(self):
        self.pieces, self.parts, self.held = {"": b""}, {}, 0

    def _keep(self, cache, text, ids):
        if len(text) <= CACHED_LENGTH:
            self.held += 4 * len(text) + len(ids) + ENTRY_BYTES
            cache[text] = ids

    def _part(self, text):
        known = self.parts.get(text)
        if known is None:
            shown = "".join(map(self.letters.__getitem__, text.encode("utf-8")))
            known = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            self._keep(self.parts, text, known)
        return known

    def _learn(self, missing):
        """Ids of pieces that are not kept; the short ones are from now on."""
        if self.held > CACHE_BYTES:
            self.clear()
        found, odd = {"": b""}, []
        for piece in missing:
            m = PLAIN.fullmatch(piece)
            if m is None:
                odd.append(piece)
            else:
                found[piece] = self._part(m[1].lower()) + (self._part(m[2]) if m[2] else b"")
        if odd:
            for piece, e in zip(odd, self.tokenizer.encode_batch(odd, add_special_tokens=False)):
                found[piece] = np.array(e.ids, dtype="<u4").tobytes()
        for piece in missing:
            self._keep(self.pieces, piece, found[piece])
        return found

    def ids(self, text):
        pieces = text.replace("\n", " ").split(" ")
        found = [*map(self.pieces.get, pieces)]
        if None in found:
            new = self._learn({p for p, f in zip(pieces, found) if f is None})
            found = [f if f is not None else new[p] for p, f in zip(pieces, found)]
        return b"".join(found)


_TOKENIZERS = {}


def cached_tokenizer(path):
    """One tokenizer and cache per Python worker, which Spark uses for many tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = CachedTokenizer(path)
    return _TOKENIZERS[path]


def combinations(bins, total, depth=DEPTH):
    """All multisets of at most ``depth`` of ``bins`` that sum to ``total``, as tuples."""
    out, known = [], set(bins)

    def extend(chosen, rest, most):
        if rest in known and rest <= most:
            out.append((*chosen, rest))
        if len(chosen) + 1 < depth:
            for b in bins:
                # The parts that follow are no larger, so b must carry its share.
                if b < rest and b <= most and b * (depth - len(chosen)) >= rest:
                    extend((*chosen, b), rest - b, b)

    extend((), total, total)
    return out


def non_negative_least_squares(a, b):
    """The x >= 0 with the least |a x - b| by active sets (Lawson and Hanson, 1974)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    for _ in range(3 * min(a.shape) + 10):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(np.argmax(gain)) if n else 0
        if not n or gain[best] <= 1e-9 * max(1.0, float(b.max())):
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            trial = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            low = trial <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - trial[low], 1e-300))
            x[at] += step * (trial - x[at])
            gone = at[x[at] <= 1e-12]
            gone = gone if len(gone) else at[low][:1]
            x[gone] = 0
            free[gone] = False
    return x


def repeat_counts(histogram, depth=DEPTH):
    """How often to use which combination: [(bins, count)], never more than there is."""
    total = len(histogram) - 1
    bins = [int(b) for b in np.flatnonzero(histogram)]
    shapes = combinations(bins, total, depth)
    if not shapes:
        return []
    row = {b: i for i, b in enumerate(bins)}
    a = np.zeros((len(bins), len(shapes)))
    for k, shape in enumerate(shapes):
        for b in shape:
            a[row[b], k] += 1
    x = non_negative_least_squares(a, histogram[bins].astype(float))
    left, used = histogram.copy(), []
    for k in np.argsort(-x, kind="stable"):
        count = min([int(x[k] + 1e-6), *(int(left[b] // shapes[k].count(b)) for b in set(shapes[k]))])
        if count > 0:
            used.append((shapes[k], count))
            for b in shapes[k]:
                left[b] -= count
    return used


def pack_remainders(lengths, window=WINDOW, bin_size=BIN):
    """Pieces (document, start within the remainder, length, sequence, offset) of remainders.

    ``lengths`` are from 1 to window - 1. Sequences count from 0.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    bins = -(-lengths // bin_size)
    n_bins = window // bin_size
    order = np.argsort(bins, kind="stable")
    histogram = np.bincount(bins, minlength=n_bins + 1)
    next_of = np.concatenate([[0], np.cumsum(histogram)])[:-1].astype(int)
    pieces, sequence = [], 0
    for shape, count in repeat_counts(histogram):
        for _ in range(count):
            offset = 0
            for b in shape:
                doc = int(order[next_of[b]])
                next_of[b] += 1
                pieces.append((doc, 0, int(lengths[doc]), sequence, offset))
                offset += int(lengths[doc])
            sequence += 1
    ends = np.cumsum(histogram)
    rest = [int(d) for b in range(n_bins + 1) for d in order[next_of[b] : ends[b]]]
    total = int(lengths[rest].sum()) if rest else 0
    room = [window] * (total // window)
    room += [1 << k for k in range(window.bit_length() - 1, -1, -1) if (total % window) >> k & 1]
    at = offset = 0
    for doc in rest:
        start = 0
        while start < lengths[doc]:
            take = min(int(lengths[doc]) - start, room[at] - offset)
            pieces.append((doc, start, take, sequence + at, offset))
            start, offset = start + take, offset + take
            if offset == room[at]:
                at, offset = at + 1, 0
    return pieces, sequence + len(room)


class Block:
    """Documents of one stretch of a partition: finished full windows, open remainders."""

    def __init__(self):
        self.rows, self.tails, self.tokens = [], [], 0

    def add(self, doc_id, ids):
        size = len(ids) // 4
        for start in range(0, size - WINDOW + 1, WINDOW):
            self.rows.append((doc_id, start, WINDOW, zlib.crc32(ids[4 * start : 4 * (start + WINDOW)]), size))
        start = size - size % WINDOW
        if start < size:
            self.tails.append((doc_id, start, ids[4 * start :], size))
            self.tokens += size - start

    def full(self):
        return self.tokens >= BLOCK_TOKENS or len(self.tails) >= BLOCK_DOCS or len(self.rows) >= BLOCK_DOCS

    def packed(self, first):
        """Result columns; sequences count from ``first``. Also the next free number."""
        rows = [(*r, first + k, 0) for k, r in enumerate(self.rows)]
        first += len(self.rows)
        pieces, used = pack_remainders([len(t[2]) // 4 for t in self.tails])
        for doc, start, length, sequence, offset in pieces:
            doc_id, base, ids, size = self.tails[doc]
            crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
            rows.append((doc_id, base + start, length, crc, size, first + sequence, offset))
        return rows, first + used


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack_documents(docs, tokenizer_path, id_col="doc_id", text_col="text"):
    """One row per piece: where it starts in its document, and its sequence and offset.

    A null text is empty and packs as its end mark alone. Repeated rows are packed each
    for itself. Sequence ids are unique and tell the partition in their high bits; they
    are not consecutive over the table. Other columns are not read.
    """

    def work(slices):
        tokenizer, block = cached_tokenizer(tokenizer_path), Block()
        end = np.array([END_ID], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 33
        for batch in slices:
            for doc_id, text in zip(*texts_of(batch, 0, 1)):
                block.add(doc_id, tokenizer.ids(text) + end)
            if block.full():
                rows, first = block.packed(first)
                block = Block()
                yield dict(zip(COLUMNS, zip(*rows)))
        rows, first = block.packed(first)
        if rows:
            yield dict(zip(COLUMNS, zip(*rows)))

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(F.col(id_col), F.col(text_col)),
        work,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
