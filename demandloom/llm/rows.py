"""Shared plumbing: bounded slices of Arrow batches, and stable held-out folds."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows handled together in Python; long texts keep this small.
SLICE_ROWS = 128


def map_slices(df, work, ddl, rows=SLICE_ROWS):
    """Apply ``work`` to an iterator of small record batches of each partition.

    ``work`` yields dicts of columns. Slices share the memory of Spark's batch, so only
    one slice is ever turned into Python objects at once.
    """
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        slices = (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))
        for columns in work(slices):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def row_and_text(docs, text_col):
    """``docs`` as two columns, a struct ``row`` of all others and ``text``, so that columns of any
    name pass a Python task unread; the schema text of ``row``; and the way back."""
    others = [f.name for f in docs.schema if f.name != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_one"))
    frame = docs.select(row.alias("row"), F.col(text_col).alias("text"))

    def back(changed):
        return changed.select(*[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])

    return frame, f"row {frame.schema['row'].dataType.simpleString()}", back


def texts_of(batch, id_col, text_col):
    """Ids and texts of a slice; a null text is empty."""
    return batch.column(id_col).to_pylist(), [t or "" for t in batch.column(text_col).to_pylist()]


def fold(id_col, folds):
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
