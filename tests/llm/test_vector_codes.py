import hashlib
import random

import numpy as np
import pytest

import oracle
from demandloom.llm import oracles, queries
from demandloom.llm import vector_codes as v


def brute_nearest(entries, x):
    gaps = [int(sum((int(a) - int(b)) ** 2 for a, b in zip(x, e))) for e in entries]
    return gaps.index(min(gaps)), min(gaps)


def brute(rows, entries, parts, rounds):
    """The contract in plain Python: (vec_id, code, error, label_error, sha) per kept row."""
    kept = [(i, [int(np.floor(np.float64(x) * 1024)) for x in vec], lab) for i, vec, lab in rows
            if vec and all(x is not None and np.isfinite(x) for x in vec)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    cut = [(width * k // parts, width * (k + 1) // parts) for k in range(parts)]
    books = [[tuple(r[1][a:b]) for r in kept[:entries]] for a, b in cut]
    for _ in range(rounds):
        for k, (a, b) in enumerate(cut):
            found = [brute_nearest(books[k], r[1][a:b])[0] for r in kept]
            for e in range(len(books[k])):
                mine = [r[1][a:b] for r, f in zip(kept, found) if f == e]
                if mine:
                    books[k][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    coded = [[brute_nearest(books[k], r[1][a:b]) for k, (a, b) in enumerate(cut)] for r in kept]
    total = {}
    for r, found in zip(kept, coded):
        total[r[2]] = total.get(r[2], 0) + sum(g for _, g in found)
    return [(r[0], "".join(f"{e:02x}" for e, _ in f), sum(g for _, g in f), total[r[2]], sha) for r, f in zip(kept, coded)]


def odd_vectors(width=8):
    rng = random.Random(11)
    make = lambda: [rng.choice([rng.uniform(-1, 1), 0.0, 0.25]) for _ in range(width)]
    rows = [(i, make(), rng.choice([1, 2, None])) for i in range(150)]
    rows += [(200, None, 1), (201, [], 1), (202, [None] * width, 2), (203, [0.1] * (width - 1) + [float("nan")], 2)]
    rows += [(-5, [float("inf")] + [0.0] * (width - 1), 1), (204, [0.5] * (width + 1), 1), (None, make(), None), (None, [0.0] * width, 1)]
    rows += [rows[3]] * 40 + [(3, make(), 2), (300, [1e4, -1e4] * (width // 2), 7), (301, [1e-30, -1e-30] * (width // 2), 7)]
    return rows


DDL = "vec_id long, embedding array<double>, label int, part int, entry int, n long, sums string, code string, vector string, _label int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "s", "c", "v", 4) for r in rows], DDL)


@pytest.mark.parametrize("entries,parts,rounds", [(256, 4, 4), (16, 4, 2), (5, 3, 3), (1, 1, 1)])
def test_against_brute_force(spark, entries, parts, rounds):
    rows = odd_vectors()
    got = v.compress(frame(spark, rows).repartition(5), entries=entries, parts=parts, rounds=rounds)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, entries, parts, rounds)))


def test_no_vectors(spark):
    schema = v.compress(frame(spark, odd_vectors())).schema
    for rows in ([], [(1, None, 1), (2, [None], None)]):
        found = v.compress(frame(spark, rows))
        assert found.collect() == [] and found.schema.fieldNames() == schema.fieldNames()


def test_large_components_are_cut_off(spark):
    rows = [(1, [1e30, -1e30, 3e5, 0.0], 1), (2, [0.0, 0.0, 0.0, 0.0], 1)]
    found = v.compress(frame(spark, rows), entries=1, rounds=0).collect()
    far = (1 << 26) ** 2 * 3
    assert {r["vec_id"]: r["error"] for r in found} == {1: 0, 2: far}


@pytest.mark.parametrize("kind", ["spread", "grouped", "equal", "large"])
@pytest.mark.parametrize("n", [1, 2, 40, 256])
def test_search_finds_the_nearest(kind, n):
    rng = np.random.default_rng(n)
    entries = {
        "spread": lambda: rng.integers(-300, 300, (n, 16)),
        "grouped": lambda: rng.integers(-9, 9, (n, 16)) + 4000 * rng.integers(0, 6, (n, 1)),
        "equal": lambda: rng.integers(0, 2, (n, 3)),
        "large": lambda: rng.integers(-(1 << 26), 1 << 26, (n, 4)),
    }[kind]()
    vectors = np.concatenate([entries, entries + rng.integers(-3, 3, entries.shape), rng.permutation(entries) + 1])
    found, gaps, visits = v.Codebook(entries).nearest(vectors)
    assert [(int(a), int(b)) for a, b in zip(found, gaps)] == [brute_nearest(entries, x) for x in vectors]
    if (kind, n) == ("grouped", 256):
        assert visits.mean() < 0.5 * n  # the lists end early where entries are far apart


def test_grouped_rows_match_sql(spark, tmp_path):
    rows = [(i, [float(np.float32(x)) for x in vec] if vec and None not in vec else vec, lab) for i, vec, lab in odd_vectors()]
    rows = [r for r in rows if not r[1] or len(r[1]) == 8]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    connection = oracle.duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    found = queries.op12_vector_codes(spark, str(tmp_path))
    assert oracle.differences(found, connection, oracles.SQL["op12_vector_codes"]) == []
