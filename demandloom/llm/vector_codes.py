"""Product codes of vectors, with codebooks in whole numbers and Orchard's search.

Vectors are cut into equal parts; each part position has a codebook, and a vector's code
names the nearest entry of each. Every sum is of whole numbers, so any order of tasks, and
a task that runs again, gives the same codebooks and codes.

The nearest entry is found by Orchard's search. Every entry keeps the list of all entries
by their distance to it. A search walks the list of its best entry so far, jumps to the
list of an entry that is nearer, passes over entries it has marked as visited, and stops
where an entry is more than twice as far from the best one as the vector is: none behind
it can be nearer. Searches that stand at one entry walk its list together, a stretch at a
time, so the distances of a stretch are one product of matrices.

A round sums parts per entry inside each task; per task at most one row per position and
entry is shuffled, and the driver holds one codebook, whose size is that of its entries.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components are cut off at this size in whole numbers, so that sums of squares stay exact.
LARGEST = 1 << 26
#: Entries of a list that searches standing at one entry visit together.
STRETCH = 128
#: Entries every search visits first, spread over the codebook, to start from a near one.
STARTS = 32
#: Components of the vectors searched at once.
BATCH = 1 << 20


class Codebook:
    """Entries of one part position, and per entry all entries in order of distance."""

    def __init__(self, entries):
        self.entries = np.asarray(entries, dtype=np.int64)
        n = len(self.entries)
        gaps = _distances(self.entries, self.entries)
        self.near = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.near, axis=1)
        self.starts = np.unique(np.linspace(0, n - 1, min(STARTS, n)).astype(np.int64))

    def nearest(self, vectors):
        """Index of the nearest entry, ties to the lower one, its squared distance, and entries visited.

        No mask hides visited entries and those out of reach from a stretch that others in
        the group still need: neither can be nearer than the best, nor as near with a lower index.
        """
        n, k = len(vectors), len(self.entries)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, self.starts] = True
        first = _distances(vectors, self.entries[self.starts])
        at = first.argmin(axis=1)
        best, gap, place = self.starts[at], first[np.arange(n), at], np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        while len(walking):
            key = best[walking] * (k + 1) + place[walking]
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            left = []
            for group in np.split(walking[order], cuts):
                entry, start = best[group[0]], place[group[0]]
                # Twice the distance is four times its square.
                reach = np.searchsorted(self.gaps[entry], 4 * gap[group], side="right")
                group = group[reach > start]
                if not len(group):
                    continue
                stop = min(start + STRETCH, int(reach.max()))
                place[group] = stop
                ids = np.sort(self.near[entry, start:stop])
                ids = ids[~seen[group[:, None], ids].all(axis=0)]
                if len(ids):
                    seen[group[:, None], ids] = True
                    far = _distances(vectors[group], self.entries[ids])
                    at = far.argmin(axis=1)
                    least, named = far[np.arange(len(group)), at], ids[at]
                    better = (least < gap[group]) | (least == gap[group]) & (named < best[group])
                    moved = group[better]
                    best[moved], gap[moved], place[moved] = named[better], least[better], 0
                left.append(group)
            walking = np.concatenate(left) if left else walking[:0]
        return best, gap, seen.sum(axis=1)


def _distances(a, b):
    """Squared distances of whole vectors, exact: in doubles where every sum fits them."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * a.shape[1] < 1 << 53:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2.0 * (x @ y.T)).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def part_bounds(width, parts=PARTS):
    return [(width * k // parts, width * (k + 1) // parts) for k in range(parts)]


def whole_vectors(rows, id_col="vec_id", vector_col="embedding", label_col="label"):
    """vec_id, label and the vector in whole numbers, of rows whose vector is whole and finite."""
    x = F.col(vector_col)
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf")))
    )
    whole = F.transform(
        x,
        lambda v: F.greatest(
            F.least(F.floor(v.cast("double") * SCALE).cast("double"), F.lit(float(LARGEST))), F.lit(float(-LARGEST))
        ).cast("int"),
    )
    return rows.where(sound).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole.alias("vector")
    )


def _matrix(batch, width):
    """The vectors of a record batch as a matrix."""
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _searched(slices, books, width):
    """Per run of rows: its batch, vectors, entries and squared distances by part."""
    held, rows = [], 0

    def run():
        batch = pa.concat_batches(held)
        vectors = _matrix(batch, width)
        found = [book.nearest(vectors[:, a:b])[:2] for book, (a, b) in zip(books, part_bounds(width, len(books)))]
        return batch, vectors, [f[0] for f in found], [f[1] for f in found]

    for batch in slices:
        held.append(batch)
        rows += batch.num_rows
        if rows * width >= BATCH:
            yield run()
            held, rows = [], 0
    if rows:
        yield run()


def _sums(vectors, books, width):
    """Count and component sums per part position and entry, over all vectors."""
    bounds = part_bounds(width, len(books.value))

    def work(slices):
        counts = [np.zeros(len(b.entries), dtype=np.int64) for b in books.value]
        sums = [np.zeros(b.entries.shape, dtype=np.int64) for b in books.value]
        for _, x, entries, _ in _searched(slices, books.value, width):
            for k, (a, b) in enumerate(bounds):
                order = np.argsort(entries[k], kind="stable")
                used, first = np.unique(entries[k][order], return_index=True)
                counts[k][used] += np.diff(np.append(first, len(order)))
                sums[k][used] += np.add.reduceat(x[order, a:b], first, axis=0)
        rows = [(k, int(e)) for k, c in enumerate(counts) for e in np.flatnonzero(c)]
        yield {
            "part": [k for k, _ in rows],
            "entry": [e for _, e in rows],
            "n": [int(counts[k][e]) for k, e in rows],
            "sums": [sums[k][e].tolist() for k, e in rows],
        }

    widest = max(b - a for a, b in bounds)
    per_task = map_slices(vectors.select("vector"), work, "part int, entry int, n long, sums array<long>")
    return per_task.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(widest)]).alias("sums")
    )


def first_entries(vectors, width, entries=ENTRIES, parts=PARTS):
    """The parts of the vectors with the least ids; of equal ids the lesser vector comes first."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    matrix = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, width)
    return [matrix[:, a:b] for a, b in part_bounds(width, parts)]


def fit_codebooks(vectors, width, entries=ENTRIES, parts=PARTS, rounds=ROUNDS):
    """Codebooks after ``rounds`` of assigning all vectors and replacing entries by floored means."""
    books = [Codebook(e) for e in first_entries(vectors, width, entries, parts)]
    for _ in range(rounds):
        sent = vectors.sparkSession.sparkContext.broadcast(books)
        means = [b.entries.copy() for b in books]
        # One row per position and entry: as many as the codebooks hold.
        for row in _sums(vectors, sent, width).collect():
            size = means[row["part"]].shape[1]
            means[row["part"]][row["entry"]] = np.array(row["sums"][:size], dtype=np.int64) // row["n"]
        books = [Codebook(m) for m in means]
    return books


def codebooks_text(books):
    return ",".join(map(str, np.concatenate([b.entries.ravel() for b in books]).tolist()))


RESULT = "code string, error long, label_error long, codebooks_sha256 string"


def compress(
    rows, id_col="vec_id", vector_col="embedding", label_col="label", entries=ENTRIES, parts=PARTS, rounds=ROUNDS
):
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept vector.

    Dropped are null and empty vectors, vectors with a null or non-finite component, and
    vectors of another width than that of the least id, which no codebook fits. Components
    beyond 2**26 in whole numbers are cut off there. Null ids come last in order, repeated
    rows stay repeated and each counts, fewer rows than entries give smaller codebooks, and
    a table without a kept vector gives no rows. Null labels are one label.
    """
    spark = rows.sparkSession
    path = shared_folder(spark, "vector-codes")
    whole_vectors(rows, id_col, vector_col, label_col).write.parquet(f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    least = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema if f.name != "vector")
    if not least:
        return spark.createDataFrame([], f"{kinds}, {RESULT}")
    width = len(least[0]["vector"])
    vectors = vectors.where(F.size("vector") == width)
    books = fit_codebooks(vectors, width, entries, parts, rounds)
    sent = spark.sparkContext.broadcast(books)

    def work(slices):
        for batch, _, found, gaps in _searched(slices, sent.value, width):
            codes = np.stack(found, axis=1).astype(np.uint8)
            yield {
                "vec_id": batch.column("vec_id"),
                "label": batch.column("label"),
                "code": [c.tobytes().hex() for c in codes],
                "error": np.sum(gaps, axis=0),
            }

    # Stored, so that the sums per label are measured before they are joined: few labels are
    # broadcast and no row moves, many are shuffled.
    map_slices(vectors, work, f"{kinds}, code string, error long").write.parquet(f"{path}/codes")
    codes = spark.read.parquet(f"{path}/codes")
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    sums.write.parquet(f"{path}/labels")
    sums = spark.read.parquet(f"{path}/labels")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
