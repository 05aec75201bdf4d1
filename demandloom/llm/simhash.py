"""SimHash fingerprints of word shingles, and links by pigeonring filtering.

Fingerprints are cut into eight segments that form a ring. If two differ in at most
three bits, then from some segment on every chain of l consecutive segments differs in
at most l * 3 / 8 bits: the first two segments agree, and of the next three at most one
differs. So the two agree in the first two and in two of the next three segments, for
some start: 24 keys of 32 bits each. Fingerprints that share a key are tested for the
chain's budgets from that start, whose last one is the full Hamming distance.

Equal fingerprints are one node from the start, however many documents share one. Of
each key's fingerprints only a star per connected part is written, not every pair, so
a group of near copies gives links in proportion to its size. Connected parts of the
whole follow from repeated joins that halve the paths, each round a stored table.
"""

import numpy as np
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices, texts_of

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
SEGMENTS = 8
WIDTH = BITS // SEGMENTS
#: Bits that a chain of l segments may differ in, l from 1 to 8.
BUDGETS = np.array([l * DISTANCE // SEGMENTS for l in range(1, SEGMENTS + 1)], dtype=np.uint8)  # noqa: E741
#: Fingerprints of one key compared in one task; larger keys are dealt out in pairs of blocks.
KEY_BLOCK = 8192
#: Rows of a comparison held at once.
COMPARED = 256

# The contract's words, over UTF-8 bytes: A-Z lower, white space to a blank.
BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def words_of(text):
    return text.encode("utf-8", "surrogatepass").translate(BYTES).split()


def fingerprint(text):
    """64 bits: bit b is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(b" ".join(words), SEED)
    n = len(words) - SHINGLE + 1
    hashes = np.fromiter(
        (digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))), dtype="<u8", count=n
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs, id_col="doc_id", text_col="text"):
    """doc_id and the 64-bit fingerprint as a signed long, for every row of ``docs``."""

    def work(slices):
        for batch in slices:
            ids, texts = texts_of(batch, 0, 1)
            yield {"doc_id": ids, "fp": [signed(fingerprint(t)) for t in texts]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs.select(id_col, text_col), work, f"doc_id {kind}, fp long")


def _segment(fp, k):
    """Segment ``k`` of the ring, as a Spark expression."""
    return F.shiftrightunsigned(fp, WIDTH * (k % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def chain_keys(nodes):
    """(key, start, fp): segments start, start + 1 and two of the next three."""
    fp = F.col("fp")
    keys = []
    for start in range(SEGMENTS):
        for skipped in range(3):
            parts = [start, start + 1, *(start + 2 + k for k in range(3) if k != skipped)]
            key = F.lit((start * 3 + skipped) << 32)
            for place, part in enumerate(parts):
                key = key.bitwiseOR(F.shiftleft(_segment(fp, part), WIDTH * place))
            keys.append(F.struct(key.alias("key"), F.lit(start).alias("start")))
    return nodes.select(F.inline(F.array(*keys)), "fp")


ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def chained(a, b, start):
    """Matrix of whether each of ``a`` and each of ``b`` pass all budgets from ``start`` on."""
    differ = ONES[(a[:, None] ^ b[None, :]).view(np.uint8).reshape(len(a), len(b), 8)]
    order = [(start + k) % SEGMENTS for k in range(SEGMENTS)]
    alive = differ[:, :, order[0]] <= BUDGETS[0]
    total = differ[:, :, order[0]].copy()
    for length, k in enumerate(order[1:], 1):
        total += differ[:, :, k]
        alive &= total <= BUDGETS[length]
    return alive


def star_links(fps, start, split=None):
    """Links that join the connected parts of ``fps`` to the least of each part.

    With ``split``, only pairs across that place count: the blocks of a large key.
    """
    fps = np.asarray(fps, dtype="<u8")
    n = len(fps)
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left = n if split is None else split
    for at in range(0, left, COMPARED):
        own = np.arange(at, min(at + COMPARED, left))
        first = at if split is None else split
        rows, columns = np.nonzero(chained(fps[own], fps[first:], start))
        for i, j in zip((rows + at).tolist(), (columns + first).tolist()):
            if i < j:
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
    heads = np.array([find(i) for i in range(n)])
    joined = np.flatnonzero(heads != np.arange(n))
    return fps[joined].view("<i8"), fps[heads[joined]].view("<i8")


def key_links(keyed):
    """Links (a, b) of fingerprints that share a key, a star per connected part of a key.

    A key with more than ``KEY_BLOCK`` fingerprints is dealt out: its fingerprints go to
    blocks, and each pair of blocks is a group of its own. Those keys are found by a
    count that is partial before its shuffle.
    """
    large = (
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > KEY_BLOCK)
        .select("key", F.ceil(F.col("n") / (KEY_BLOCK // 2)).cast("int").alias("blocks"))
    )
    spread = keyed.join(large, "key", "left")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(other, block).alias("low"), F.greatest(other, block).alias("high"), (block > other).cast("int").alias("side")
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side")))
    dealt = spread.select("key", "start", "fp", F.inline(F.when(F.col("blocks").isNull(), whole).otherwise(pairs)))
    # Rows of a group are neighbours in one partition, in order.
    ordered = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "side", "fp")

    def work(slices):
        import pyarrow as pa

        held = None
        for b in slices:
            now = pa.Table.from_batches([b])
            held = now if held is None else pa.concat_tables([held, now])
            names = [held[c].to_numpy() for c in ("key", "low", "high")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
            if not len(change):
                continue
            yield _links_of(held.slice(0, int(change[-1])))
            held = held.slice(int(change[-1]))
        if held is not None:
            yield _links_of(held)

    return map_slices(ordered, work, "a long, b long")


def _links_of(table):
    """Star links of all groups in a table that holds whole groups."""
    key, low, high, side, start, fp = (table[c].to_numpy() for c in ("key", "low", "high", "side", "start", "fp"))
    edges = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
    bounds = np.concatenate([[0], edges, [len(key)]])
    a, b = [], []
    for at in np.flatnonzero(np.diff(bounds) > 1):
        own = slice(bounds[at], bounds[at + 1])
        split = None if low[own][0] == high[own][0] else int((side[own] == 0).sum())
        x, y = star_links(fp[own].astype("<i8").view("<u8"), int(start[own][0]), split)
        a.append(x)
        b.append(y)
    empty = np.zeros(0, dtype=np.int64)
    return {"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])}


def least_reachable(links):
    """(fp, root) of every linked fingerprint: the least fingerprint it reaches.

    Every node points at the least neighbour it knows; pointers are then followed and
    links drawn up to the roots, round by round, until nothing changes. Each round is a
    stored table, so a lost executor costs one round.
    """
    spark = links.sparkSession

    def stored(frame):
        path = shared_folder(spark, "simhash")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    edges = links
    while True:
        # Large star: neighbours above a node move to the least around it.
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        )
        # Small star: neighbours below a node, and the node itself, move to the least of them.
        below = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(below, "b")
        small = moved.select(F.col("m").alias("a"), F.col("a").alias("b")).union(
            moved.select(F.col("m").alias("a"), "b")
        )
        following = stored(small.where("a < b").distinct())
        # Done when every node has one link, to a node that has none of its own.
        nodes = following.select(F.col("b").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(
            following.select(F.col("a"), F.lit(0), F.lit(1))
        )
        open_nodes = nodes.groupBy("n").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where(
            "low > 1 or (low = 1 and high = 1)"
        )
        edges = following
        if open_nodes.isEmpty():
            return edges.select(F.col("b").alias("fp"), F.col("a").alias("root"))


def near_duplicates(docs, id_col="doc_id", text_col="text"):
    """doc_id, fp and component_id, the least doc_id that is linked by some path.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows and
    equal texts fall together. Other columns are not read. A null id names no component:
    such rows get the least id of their component, or null if it has none.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "simhash")
    fingerprints(docs, id_col, text_col).write.parquet(f"{path}/fingerprints")
    found = spark.read.parquet(f"{path}/fingerprints")
    found.groupBy("fp").agg(F.min("doc_id").alias("least_id")).write.parquet(f"{path}/nodes")
    nodes = spark.read.parquet(f"{path}/nodes")
    roots = least_reachable(key_links(chain_keys(nodes)))
    linked = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    components = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = linked.join(components, "root").select("fp", "component_id")
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs, id_col="doc_id", text_col="text"):
    """``docs`` with one row of each component, that of the least id.

    Rows with one id are one document, of which one row stays. Rows without an id cannot
    be named as copies and stay.
    """
    found = near_duplicates(docs, id_col, text_col)
    keep = found.groupBy("component_id").agg(F.min("doc_id").alias(id_col)).where(F.col(id_col).isNotNull())
    named = docs.where(F.col(id_col).isNotNull()).join(keep.select(id_col), id_col, "left_semi")
    return named.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))
