"""Table layouts for lookups and joins: a space-filling curve with Bloom filters (M2, I1-I7) and buckets (M4).

`write_clustered` orders rows along a Z-order curve over several columns, so that each row group spans a small part of
every one of them and its min/max (and, for columns of many values, its Bloom filter) lets a filter on any of them skip
it.  `write_bucketed` deals rows to buckets of a key, so that joins and aggregates by that key need no exchange.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows the curve's boundaries are estimated from; they shape the layout only, never a result.
BOUND_ROWS = 100_000


def curve_bounds(df: DataFrame, columns: list[str], bits: int = 6, rows: int = BOUND_ROWS) -> dict[str, list[tuple]]:
    """Per column up to 2^bits ascending (boundary, cell): values from the boundary on, up to the next one, get the cell.

    The boundaries part the values into about equal shares of rows; the cell, of 2^bits, is the place of the share's
    middle among all rows, so that a value as common as many shares takes their room on the curve.  All comes from a random sample of
    about `rows` rows, the only data that reaches the driver.
    """
    total = df.count()
    sample = df.select(*columns).sample(fraction=min(1.0, rows / total), seed=17).collect() if total else []
    size, bounds = 2 ** bits, {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        found = sorted(set(values))
        if len(found) > size:
            found = sorted({values[len(values) * i // size] for i in range(size)})
        starts = [bisect.bisect_left(values, f) for f in found] + [len(values)]
        bounds[c] = [(f, size * (starts[i] + starts[i + 1]) // (2 * len(values))) for i, f in enumerate(found)]
    return bounds


def _cell(name: str, bounds: list[tuple]) -> Column:
    """The value's cell (0 below all boundaries and for NULL), found by halving."""
    col = F.col(name)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(bounds[lo - 1][1] if lo else 0)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(bounds[mid][0]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return F.when(col.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def curve_position(columns: list[str], bits: int) -> Column:
    """Z-order position of integer columns of `bits` bits each: their bits interleaved, the first column's first."""
    z = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for c in columns:
            z = z * 2 + F.shiftright(F.col(c), b).bitwiseAND(F.lit(1))
    return z


def write_clustered(df: DataFrame, path: str, columns: list[str], bloom: tuple[str, ...] = (), files: int | None = None,
                    bits: int = 6, group_bytes: int = 32 << 20, bloom_values: int = 200_000) -> None:
    """Write df as Parquet ordered along the curve over `columns`, with Bloom filters on the columns `bloom`.

    The boundaries take one count and one pass over these columns; the rest is one range shuffle on the curve's position
    (and a hash of the row, so that rows alike in all columns still spread).  `files` defaults to Spark's choice.
    Position columns are not stored.  Cluster by a date, not by a time without zone: Spark does not skip row groups by the latter.
    """
    if bits * len(columns) > 62:
        raise ValueError("the curve's position must fit a long")
    bounds = curve_bounds(df, columns, bits)
    cells = [f"__cell_{i}" for i in range(len(columns))]
    placed = df.select("*", *[_cell(c, bounds[c]).alias(n) for c, n in zip(columns, cells)],
                       F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)]).alias("__row"))
    placed = placed.withColumn("__curve", curve_position(cells, bits)).drop(*cells)
    placed = placed.repartitionByRange(*([files] if files else []), "__curve", "__row").sortWithinPartitions("__curve", *columns)
    writer = placed.drop("__curve", "__row").write.mode("errorifexists").option("parquet.block.size", group_bytes)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", bloom_values)
    writer.parquet(path)


def _hashable(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType.simpleString()
    return "map<" not in kind and "variant" not in kind


def buckets_for(rows: int, rows_per_bucket: int = 5_000_000, least: int = 8) -> int:
    """A power of two of buckets, so that tables of unlike size still join bucket by bucket (coalesced)."""
    return 2 ** max(math.ceil(math.log2(least)), math.ceil(math.log2(max(1, rows / rows_per_bucket))))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, sort: tuple[str, ...] = ()) -> DataFrame:
    """Save df as the table `table` at `path`, dealt to `buckets` buckets of `key` (one file each, sorted), and read it.

    All rows of a key are one bucket, which one task reads: meant for keys like users; where one key holds a large part
    of the rows, keep the plain table, whose aggregates combine before they shuffle.
    """
    (df.repartition(buckets, key).write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, *sort).saveAsTable(table))
    return df.sparkSession.table(table)
