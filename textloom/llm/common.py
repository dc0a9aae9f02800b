"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: White space of the word rule `[^\x20\x09-\x0D]+`; bytes.split() cuts at exactly these.
SPACES = " \t\n\r\x0b\x0c"

_SLICE = 256


def add_columns(
    df: DataFrame,
    inputs: list[Column],
    keep: list[Column],
    added: str,
    make: Callable[[], Callable[..., list[tuple]]],
) -> DataFrame:
    """`keep` columns followed by the columns of the DDL `added`, computed in Arrow batches.

    `make` runs once per task and returns a function that gets one Python list per
    input column, at most 256 rows at a time, and returns one tuple per row. What is
    kept stays in Arrow form. Names of `added` must differ from the names kept. Bytes of an
    input text that are not valid UTF-8 are read as U+FFFD.
    """
    kinds = df.select(*inputs).schema.fields
    inputs = [F.make_valid_utf8(c) if isinstance(f.dataType, T.StringType) else c for c, f in zip(inputs, kinds)]
    inner = df.select(*keep, *[c.alias(f"__in{i}") for i, c in enumerate(inputs)])
    number = len(inputs)
    width = len(inner.columns) - number
    fields = T.StructType(inner.schema.fields[:width] + T.StructType.fromDDL(added).fields)
    target = to_arrow_schema(fields)
    new = [target.field(i) for i in range(width, len(target))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                rows = function(*[part.column(width + i).to_pylist() for i in range(number)])
                columns = list(zip(*rows)) if rows else [()] * len(new)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(width)]
                    + [pa.array(c, type=f.type) for c, f in zip(columns, new)],
                    schema=pa.schema([part.schema.field(i) for i in range(width)] + new),
                )

    return inner.mapInArrow(run, fields)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that the table has a column of, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32 of the key as text has the given remainder; null keys count as text 'null'."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return (F.crc32(text.cast("binary")) % modulus) == remainder


def smallest_hashes(df: DataFrame, columns: list[str], most: int, total: int) -> DataFrame:
    """The `most` rows with the smallest hash of the columns, of a table of `total` rows.

    Rows that are clearly beyond are dropped where they lie, so what the tasks hand on to be
    sorted stays near twice `most`, however many tasks there are. If chance leaves fewer rows than
    that below the limit, the sample is as much smaller.
    """
    place = F.xxhash64(*columns)
    if total > 4 * most:
        share = 2 * most / total
        df = df.where(place < F.lit(int(-(2**63) + share * 2**64)))
    return df.orderBy(place, *columns).limit(most)


def sampled_labels(labels: DataFrame, target: str, training: Column, most: int) -> DataFrame:
    """At most `most` labelled training rows of each class, by the hash of their id.

    The bound holds at any size of the input, so the rows may be collected or
    broadcast. Ids with labels that contradict each other are left out.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & training)
        .groupBy("doc_id")
        .agg(F.min(target).alias("y"), F.max(target).alias("y2"))
        .where("y = y2")
        .select("doc_id", "y")
    )
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    no, yes = (smallest_hashes(known.where(F.col("y") == y), ["doc_id"], most, sizes.get(y, 0)) for y in (0, 1))
    return no.unionByName(yes)
