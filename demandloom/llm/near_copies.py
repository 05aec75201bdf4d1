"""One document of each group whose five-word shingles agree to four fifths.

Candidates come by the method of ``simhash``, fingerprints and pigeonring chains, and each is
tested on the whole sets of shingles, so nothing goes that is not close to a row kept. At a
similarity of 0.8 three bits of 64 are far too few: a tenth to a sixth of all bits differ. So a
fingerprint here has 1,280 bits, a ring of 160 segments of eight. If two differ in fewer bits
than half the segments, then from some segment on a chain of two segments has a budget of none:
the two agree there. That start and the two segments are the key. Beyond that distance no start
must agree, but 160 may: at 0.8 some one does but for a few pairs in ten thousand. The chain is
then followed over 16 segments, with a budget of its own, before a pair is a candidate.

Documents are numbered by id. Within a key each is paired with the first candidate before it, and
it is tested against the first of all that are not gone, then against four times as many, and so
on; a round reads what the round before left open, so a candidate is read again only while both of
its documents stay. So a group of near copies gives tests in proportion to its size and to the rows
that stay of it. The whole ring has a budget too, and only pairs within it have their sets looked
up. A document goes if it is close to one that stays, and one stays for good when all its candidates
before it are tested or gone. Documents whose keys had more candidates go through those keys again,
with eight times the number each time, until every candidate that is not gone is tested. Most of a
group is gone by then, and a bitmap of the keys leaves out all others, so the few rows left carry
their whole rings, and only pairs within the ring's budget count. Each round is a stored table.
"""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices, row_and_text, texts_of
from .simhash import KEY_BLOCK, signed, words_of

SHINGLE = 5
#: Least similarity as a fraction of whole numbers.
SIMILAR = (4, 5)
#: Segments of the ring, one byte each.
SEGMENTS = 160
#: Segments of a chain, the first two of which are the key, and the bits that the others may differ in.
CHAIN = 16
BUDGET = 24
#: Bits that whole rings may differ in: at 0.8 they differ in 192 with a deviation of 13.
RING_BUDGET = 245
#: Candidates before a document that each of its keys gives in the first pass, and their growth.
HEADS = 1
HEADS_GROWTH = 8
#: Growth of the number of a document's candidates that a round tests; the first round tests one.
TESTS_GROWTH = 4
SEED = 42
#: Shingles added up at once: their counts of bits fit a byte.
CHUNK = 255
#: Fingerprints, or rows of keys, handled together.
RINGS = 1024
CHAINS = 65536

# Streams of 64 bits per shingle, mixed as in SplitMix64.
STREAMS = np.random.default_rng(SEED).integers(0, 1 << 63, SEGMENTS // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIXERS = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))


def shingles(words):
    """Distinct 64-bit hashes of the five-word shingles; fewer words are one shingle."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    parts = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    return np.unique(np.fromiter((digest(s, SEED) for s in parts), dtype=np.uint64, count=len(words) - SHINGLE + 1))


def ring(hashes):
    """The fingerprint as 64-bit numbers, one byte per segment: a bit is set if it is set for over half of the shingles."""
    counts = np.zeros(SEGMENTS * 8, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        mixed = hashes[at : at + CHUNK, None] + STREAMS
        for shift, factor in MIXERS:
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(hashes)).view(np.int64).tolist()


def _keys(rings):
    """Key of each segment of each ring: its number, it and the next one."""
    return np.arange(SEGMENTS, dtype=np.int32) << 16 | rings.astype(np.int32) << 8 | np.roll(rings, -1, axis=1)


def _rings(batch):
    return batch.column("ring").flatten().to_numpy().view(np.uint8).reshape(-1, SEGMENTS)


def chains(nodes, wanted=None):
    """(key, rank, a, b) for each segment of each node: the chain from there on as two numbers.

    With ``wanted``, a bitmap, only of its keys, and with the whole ring.
    """
    ddl = "key int, rank long, a long, b long" + ("" if wanted is None else ", ring binary")

    def work(slices):
        for batch in slices:
            rings = _rings(batch)
            keys = _keys(rings)
            around = np.concatenate([rings, rings[:, : CHAIN - 1]], axis=1)
            parts = np.lib.stride_tricks.sliding_window_view(around, CHAIN, axis=1)
            node, start = np.nonzero(np.ones_like(keys) if wanted is None else wanted[keys >> 3] >> (keys & 7) & 1)
            parts = np.ascontiguousarray(parts[node, start]).view(np.int64)
            found = {"key": keys[node, start], "rank": batch.column("rank").to_numpy()[node], "a": parts[:, 0], "b": parts[:, 1]}
            yield found if wanted is None else {**found, "ring": [rings[k].tobytes() for k in node]}

    return map_slices(nodes.select("rank", "ring"), work, ddl, RINGS)


def key_bitmap(keys):
    """All keys as one bit each, 1.3 MB however many there are."""
    after = F.col("key") + 1  # Spark's buckets of 32,768 bits start at 1
    buckets = keys.groupBy(F.bitmap_bucket_number(after)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(after)))
    bits = np.zeros((SEGMENTS * 2, 4096), dtype=np.uint8)
    for bucket, own in buckets.collect():
        bits[bucket - 1] = np.frombuffer(own, dtype=np.uint8)
    return bits.ravel()


def hot_keys(nodes, wanted=None):
    """Keys of over ``KEY_BLOCK`` nodes, and the number of blocks that they are dealt out in.

    Only keys that come twice in a slice are counted, so a key near the limit may be left out,
    and with ``wanted`` only its keys.
    """

    def work(slices):
        for batch in slices:
            keys, n = np.unique(_keys(_rings(batch)), return_counts=True)
            often = n > 1 if wanted is None else (n > 1) & (wanted[keys >> 3] >> (keys & 7) & 1 > 0)
            yield {"key": keys[often], "n": n[often]}

    counts = map_slices(nodes.select("rank", "ring"), work, "key int, n long", 4 * RINGS).groupBy("key").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") > KEY_BLOCK).select("key", F.ceil(F.col("n") / (KEY_BLOCK // 2)).cast("int").alias("blocks"))


def _dealt(keyed, hot):
    """Rows of hot keys, once for each pair of blocks that has the block of the row."""
    block = F.pmod(F.xxhash64("rank"), F.col("blocks")).cast("int")
    both = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, block).alias("low"), F.greatest(other, block).alias("high"), (block > other).cast("int").alias("side")),
    )
    return keyed.join(hot, "key").select(*keyed.columns, F.inline(both))


def _met(keyed, by, most):
    """(key, head, rank, more): per group the first ``most`` candidates before each row; the last says if there are more."""
    ordered = keyed.repartition(*by).sortWithinPartitions(*by, "rank")

    def work(slices):
        import pyarrow as pa

        held = None
        for batch in slices:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            names = [held[c].to_numpy() for c in by]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
            if not len(change):
                continue
            yield from _met_in(held.slice(0, int(change[-1])), by, most)
            held = held.slice(int(change[-1])).combine_chunks()
        if held is not None:
            yield from _met_in(held, by, most)

    return map_slices(ordered, work, "key int, head long, rank long, more boolean", CHAINS)


def _met_in(table, by, most):
    key, rank, *names = (table[c].to_numpy() for c in ("key", "rank", *by))
    a, b = (table[c].to_numpy().view(np.uint64) for c in "ab")
    rings = None
    if "ring" in table.column_names:
        rings = np.frombuffer(b"".join(table["ring"].to_pylist()), dtype=np.uint64).reshape(-1, SEGMENTS // 8)
    opens = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in names], axis=0)])
    first = np.maximum.accumulate(np.where(opens, np.arange(len(key)), 0))
    place, found = np.arange(len(key)) - first, np.zeros(len(key), dtype=np.int64)
    last, left, at, heads, rows = np.zeros(len(key), dtype=np.int64), np.flatnonzero(place), 0, [], []
    while len(left):
        head = first[left] + at
        close = np.bitwise_count(a[left] ^ a[head]) + np.bitwise_count(b[left] ^ b[head]) <= BUDGET
        if "side" in table.column_names:
            side, low, high = (table[c].to_numpy() for c in ("side", "low", "high"))
            close &= (side[left] != side[head]) | (low[left] == high[left])
        mine, head = left[close], head[close]
        if rings is not None:
            near = np.bitwise_count(rings[mine] ^ rings[head]).sum(axis=1) <= RING_BUDGET
            mine, head = mine[near], head[near]
        found[mine] += 1
        early, final = found[mine] < most, found[mine] == most
        heads.append(rank[head[early]])
        rows.append(mine[early])
        last[mine[final]] = rank[head[final]]
        at += 1
        left = left[(place[left] > at) & (found[left] <= most)]
        if not len(left) or sum(map(len, rows)) > CHAINS:
            own = np.concatenate(rows)
            yield {"key": key[own], "head": np.concatenate(heads), "rank": rank[own], "more": np.zeros(len(own), dtype=bool)}
            heads, rows = [], []
    own = np.flatnonzero(found >= most)
    yield {"key": key[own], "head": last[own], "rank": rank[own], "more": found[own] > most}


def node_of(words):
    import xxhash

    return signed(xxhash.xxh64_intdigest(b" ".join(words), SEED))


def _mapped(docs, ddl, make):
    """doc_id, node and the columns of ``ddl``, which ``make`` gives from a text's words, for every row of doc_id and text."""
    names = [c.split()[0] for c in ddl.split(", ")]

    def work(slices):
        for batch in slices:
            ids, texts = texts_of(batch, 0, 1)
            words = [words_of(t) for t in texts]
            made = zip(*map(make, words)) if words else [[]] * len(names)
            yield {"doc_id": ids, "node": [node_of(w) for w in words], **dict(zip(names, made))}

    return map_slices(docs, work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node long, {ddl}")


def _ringed(words):
    return (ring(shingles(words)),)


def dropped_nodes(docs, id_col="doc_id", text_col="text"):
    """rank, node and least_id of all nodes, and the ranks of those that are close to one that stays.

    A node is a text as words, so equal texts are one node. Its id is its least doc_id, and
    ranks go by that id and then by the node.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    path = shared_folder(spark, "near-copies")

    def stored(frame, name):
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    def so_far(name, ddl, count):
        """The tables of all rounds so far in one scan."""
        return spark.read.schema(ddl).parquet(*[f"{path}/{name}-{k}" for k in range(count)]) if count else spark.createDataFrame([], ddl)

    rows = stored(_mapped(docs.where("doc_id is not null"), "ring array<long>", _ringed), "rows")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("ring").alias("ring"))
    # In the order of ids the numbers of rows grow, whatever the type of the ids.
    nodes = stored(nodes.orderBy("least_id", "node").withColumn("rank", F.monotonically_increasing_id()), "nodes")

    def without(pairs, gone):
        return pairs.join(gone.withColumnRenamed("rank", "b"), "b", "left_anti").join(gone.withColumnRenamed("rank", "a"), "a", "left_anti")

    number = tests = steps = 0
    wanted = None
    while True:
        # The first pass takes all nodes, later ones the keys in which candidates were left out.
        here = nodes.join(so_far("gone", "rank long", steps), "rank", "left_anti")
        most = HEADS * HEADS_GROWTH**number
        keyed = chains(here, wanted)
        hot = stored(hot_keys(here, wanted), f"hot-{number}")
        if hot.isEmpty():
            met = _met(keyed, ["key"], most)
        else:
            met = _met(keyed.join(hot, "key", "left_anti"), ["key"], most).union(_met(_dealt(keyed, hot), ["key", "low", "high"], most))
        met = stored(met, f"met-{number}")
        more = met.where("more").select("key", "rank")
        candidates = met.select(F.col("head").alias("a"), F.col("rank").alias("b")).distinct()
        candidates = candidates.join(so_far("pairs", "a long, b long", tests), ["a", "b"], "left_anti")

        share = 1
        while True:
            left = candidates.withColumn("place", F.row_number().over(Window.partitionBy("b").orderBy("a")))
            left = stored(left, f"left-{tests}")
            waiting = left.where(F.col("place") == share + 1).select(F.col("b").alias("rank"))
            pairs = stored(left.where(F.col("place") <= share).select("a", "b"), f"pairs-{tests}")
            stored(_close(docs, nodes, pairs, lambda frame, name: stored(frame, f"{name}-{tests}")), f"close-{tests}")  # noqa: B023
            tests += 1
            while True:
                # Of the close pairs whose nodes are both open, a head is the later one of none and waits for no candidate.
                close = stored(without(so_far("close", "a long, b long", tests), so_far("gone", "rank long", steps)), f"open-{steps}")
                unsettled = close.select("b").union(more.select("rank")).union(waiting).toDF("a").distinct()
                heads = close.select("a").distinct().join(unsettled, "a", "left_anti")
                now = stored(close.join(heads, "a", "left_semi").select(F.col("b").alias("rank")).distinct(), f"gone-{steps}")
                steps += 1
                if now.isEmpty():
                    break
            if waiting.isEmpty():
                break
            # Every round reads only what the one before has left open.
            candidates = without(left.where(F.col("place") > share).select("a", "b"), so_far("gone", "rank long", steps))
            share *= TESTS_GROWTH
        gone = so_far("gone", "rank long", steps)
        keys = stored(more.join(gone, "rank", "left_anti").select("key").distinct(), f"keys-{number}")
        if keys.isEmpty():
            return nodes, gone
        wanted = key_bitmap(keys)
        number += 1


def _close(docs, nodes, pairs, stored):
    """The pairs of which the sets of shingles are close.

    Few rows meet all nodes or texts here. They are stored first, so that Spark knows how few
    they are before it deals out nodes or texts for a join.
    """
    ends_of = lambda pairs: pairs.withColumn("rank", F.explode(F.array("a", "b")))
    side = lambda c, of: F.max(F.when(F.col("rank") == F.col(c), F.col(of)))
    rings = ends_of(pairs).join(nodes.select("rank", "ring"), "rank").groupBy("a", "b").agg(side("a", "ring").alias("p"), side("b", "ring").alias("q"))
    differ = F.aggregate(F.zip_with("p", "q", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda x, y: x + y)
    near = stored(rings.where(differ <= RING_BUDGET).select("a", "b"), "near")
    ends = ends_of(near)
    ranks = stored(ends.select("rank").distinct(), "ends")
    wanted = stored(nodes.join(ranks, "rank", "left_semi").select("rank", "node", F.col("least_id").alias("doc_id")), "wanted")
    texts = docs.join(wanted.select("doc_id"), "doc_id", "left_semi")
    found = _mapped(texts, "hashes array<long>", lambda w: (shingles(w).view(np.int64).tolist(),))
    sets = stored(found.join(wanted, ["node", "doc_id"]).dropDuplicates(["rank"]).select("rank", "hashes"), "sets")
    met = ends.join(sets, "rank").groupBy("a", "b").agg(side("a", "hashes").alias("x"), side("b", "hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return met.where(both * SIMILAR[1] >= (F.size("x") + F.size("y") - both) * SIMILAR[0]).select("a", "b")


def keep_one(docs, id_col="doc_id", text_col="text"):
    """``docs`` without equal texts and near copies of rows that stay, with all their columns.

    The row with the least id stays; of repeated rows one stays. Rows that share only the id
    are documents of their own. Rows without an id cannot be named as copies and stay. Null
    and empty texts are texts without a word, all equal. An empty table gives no rows, and
    columns may have any names.
    """
    nodes, gone = dropped_nodes(docs, id_col, text_col)
    keep = nodes.join(gone, "rank", "left_anti").select(F.col("node").alias("kept_node"), F.col("least_id").alias("kept_id"))

    frame, columns, back = row_and_text(docs, text_col)
    own_id = F.col("row").getField(id_col)

    def work(slices):
        for batch in slices:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield {"row": batch.column("row"), "text": batch.column("text"), "node": [node_of(words_of(t)) for t in texts]}

    named = map_slices(frame.where(own_id.isNotNull()), work, f"{columns}, text string, node long").withColumn("id", own_id)
    kept = named.join(keep, (F.col("node") == F.col("kept_node")) & (F.col("id") == F.col("kept_id")), "left_semi")
    return back(kept.dropDuplicates(["id", "node"])).unionByName(docs.where(F.col(id_col).isNull()))
