"""Compare a Spark result with the SQL result of the same query."""

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_frame(pdf):
    pdf = pdf[sorted(pdf.columns)]
    for c in pdf.columns:
        if pdf[c].dtype == object or str(pdf[c].dtype).startswith("datetime"):
            pdf = pdf.assign(**{c: pdf[c].astype(str).str.slice(0, 10) if "date" in c else pdf[c]})
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def differences(spark_df, con, sql):
    """Problems found, as text lines; empty when both sides agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    problems = []
    for name, kind in spark_df.dtypes:
        if expected_types.get(name) != SAME_TYPE.get(kind):
            problems.append(f"{name}: {kind} against {expected_types.get(name)}")
    if set(expected_types) != set(spark_df.columns):
        return problems + [f"columns {spark_df.columns} against {list(expected_types)}"]
    got, want = sorted_frame(spark_df.toPandas()), sorted_frame(relation.df())
    if len(got) != len(want):
        return problems + [f"{len(got)} rows against {len(want)}"]
    for c in got.columns:
        a, b = got[c], want[c]
        if pd.api.types.is_float_dtype(a) or pd.api.types.is_float_dtype(b):
            same = np.array_equal(a.astype(float), b.astype(float), equal_nan=True)
        else:
            same = (a.isna() == b.isna()).all() and (a.dropna().astype(str) == b.dropna().astype(str)).all()
        if not same:
            bad = [(x, y) for x, y in zip(a, b) if not (x == y or (pd.isna(x) and pd.isna(y)))][:3]
            problems.append(f"{c}: {bad}")
    return problems
