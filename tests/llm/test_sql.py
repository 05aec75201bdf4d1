"""The queries of the package that SQL can express, against DuckDB on whole tables."""

import random
import string

import pytest

import oracle
from demandloom.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_sql(spark, sf_dir, name):
    rows = queries.QUERIES[name](spark, sf_dir)
    assert oracle.differences(rows, oracle.connect(sf_dir), oracles.SQL[name]) == []


def test_all_windows_lengths(spark, tmp_path):
    """Items shorter than a window, null texts and repeated rows, which the tables lack."""
    docs = [(1, "One two THREE four"), (1, "one two"), (2, None), (3, ""), (4, "zéro one-two " * 9), (5, "a b c d e f g h i j k l")]
    items = [(10, "two"), (9, "one two three"), (8, None), (7, "..."), (6, "b c d e f g h i j k"), (5, "x a b c d e f g h i j"), (10, "two")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    connection = oracle.duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    rows = queries.op2_decontamination(spark, str(tmp_path))
    assert oracle.differences(rows, connection, oracles.SQL["op2_decontamination"]) == []


def test_spans_of_every_kind(spark, tmp_path):
    """Random pieces of keys, checksums and words, which the tables hold few of."""
    rng = random.Random(13)
    key = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    base64, base32 = string.ascii_letters + string.digits + "+/_-", string.ascii_uppercase + "234567"
    pieces = [
        lambda: key(rng.randint(15, 60), base64), lambda: key(rng.randint(20, 40), base32), lambda: key(rng.randint(20, 50), "0123456789abcdefABCDEF"),
        lambda: "AKIA" + key(rng.randint(10, 20), base32), lambda: "password = '" + key(rng.randint(3, 12), base64), lambda: "é word-of-mouth 2020",
        lambda: "sha256: " + key(40, "0123456789ABCDEF"), lambda: "ſecret=" + key(25, base64), lambda: "123e4567-e89b-12d3-a456-426614174000",
        lambda: "aaaaaaaaaaaaaaaaaaaaaaaa1111" + key(30, base64), lambda: "TOKEN:" + key(30, "abc"), lambda: ";base64," + key(30, base64),
    ]
    rows = [(i, "".join(rng.choice(pieces)() + rng.choice(["", " ", "\n", "."]) for _ in range(rng.randint(0, 6)))) for i in range(300)]
    spark.createDataFrame([*rows, (7, None), rows[5]], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    connection = oracle.duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = queries.op1_secret_scan(spark, str(tmp_path))
    assert oracle.differences(found, connection, oracles.SQL["op1_secret_scan"]) == []
    kinds = {s.split(":")[0] for r in found.collect() for s in r["spans"].split(",") if s}
    assert kinds == {"assign", "access", "hex", "entropy_hex", "entropy_base32", "entropy_base64", "entropy_mixed"}
