"""Merges of a few rows into a written relation: only the partitions that the rows meet are read, and only those are written.

`writes` says what a relation becomes (insert, upsert, replace, delete) as a function of old rows and new ones; here such a
function is applied to a folder. A relation is laid out in partition folders: by columns of its own (facts by concept), or
by a hash of its key in as many parts as its counted size asks for, a number that the partition column's name holds. What
decides the outcome for a key must lie in the partition of that key, so a change is a function of one partition's rows.

* `append_new` adds the rows that the relation does not hold. It reads the key columns alone, of the partitions that the
  rows are in, between their least and largest key (which skips row groups of sorted files), and adds files; no file that
  is there is touched.
* `merge` puts change(old rows, new rows) in place of the partitions that the new rows meet, by dynamic partition
  overwrite. Files of other partitions stay as they are. A partition that ends up empty is removed.

Neither is a transaction: one writer at a time, and a reader that runs along may see some partitions before and some after.

Cases: no new rows leave all as it is; a null key is a key like others (it has a partition of its own or of its hash);
columns that the new rows lack are null where the change says nothing else; a relation that does not exist is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from factloom.operators.writes import CODEC, IDENTITY, new_facts
from factloom.session import delete_path, kept, kept_with

#: Rows of a part and of a file.
PART_ROWS, FILE_ROWS = 5_000_000, 5_000_000
PART = re.compile(r"part_of_(\d+)$")


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def lay_out(rows: DataFrame, folder: str, key: str, by: tuple[str, ...] = (), part_rows: int = PART_ROWS, file_rows: int = FILE_ROWS) -> None:
    """Writes a relation to a new folder: partitioned by the given columns, or by parts of its key, and sorted by the key.
    A frequent key's rows may fill several files, and a file's rows are of few keys."""
    n = rows.count()
    if not by:
        parts = max(1, -(-n // part_rows))
        by, rows = (f"part_of_{parts}",), rows.withColumn(f"part_of_{parts}", _part(key, parts))
    _put(rows, folder, by, key, max(1, -(-n // file_rows)), "errorifexists")


def _put(rows: DataFrame, folder: str, by: tuple[str, ...], key: str, files: int, mode: str) -> None:
    order = [*by, key, *[c for c in rows.columns if c not in by and c != key][:1]]
    writer = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("compression", CODEC).partitionBy(*by)
    (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if mode == "dynamic" else writer.mode(mode)).parquet(folder)


def _opened(spark: SparkSession, folder: str) -> tuple[DataFrame, tuple[str, ...]]:
    """The relation with its partition columns, and their names. Partition columns are strings, unless they are parts."""
    found = spark.read.parquet(folder)
    one = found.select("_metadata.file_path").first()
    names = [c for c in re.findall(r"([^/=]+)=[^/]*(?=/)", one[0] if one else "") if c in found.columns]
    if not names:
        raise ValueError(f"{folder} has no partitions or no rows")
    schema = StructType([f for f in found.schema.fields if f.name not in names])
    for name in names:
        schema = schema.add(name, "integer" if PART.match(name) else "string")
    return spark.read.schema(schema).parquet(folder), tuple(names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The relation without columns that only place its rows."""
    found, by = _opened(spark, folder)
    return found.drop(*[c for c in by if PART.match(c)])


def _placed(rows: DataFrame, by: tuple[str, ...], key: str) -> DataFrame:
    """rows with the partition columns that they lack."""
    return rows.withColumns({c: _part(key, int(PART.match(c)[1])) for c in by if PART.match(c)})


def _met(rows: DataFrame, by: tuple[str, ...]) -> Column | None:
    """The condition that holds in the partitions of the rows; None where there are no rows. Partitions are folders, and
    so few enough to be named."""
    values = [tuple(r) for r in rows.select(*by).distinct().collect()]
    if not values:
        return None
    if len(by) == 1:
        plain, null = [v for (v,) in values if v is not None], any(v is None for (v,) in values)
        return reduce(lambda a, b: a | b, [*([F.col(by[0]).isin(plain)] if plain else []), *([F.col(by[0]).isNull()] if null else [])])
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, value, strict=True)]) for value in values])


def append_new(spark: SparkSession, folder: str, rows: DataFrame, key: str = "cik", identity: tuple[str, ...] = IDENTITY, ordinal: str = "ordinal", file_rows: int = FILE_ROWS) -> int:
    """Appends the first row of each identity by ordinal that the relation does not hold, and returns how many. The
    partition columns must be of the identity, or parts of its key."""
    old, by = _opened(spark, folder)
    given, seen = kept_with(_placed(rows, by, key), "given", low=F.min(key), high=F.max(key), nulls=F.count_if(F.col(key).isNull()))
    met = _met(given, by)
    if met is None:
        return 0
    low, high, nulls = seen["low"], seen["high"], seen["nulls"]
    inside = F.col(key).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
    known = old.where(met & (inside | F.col(key).isNull() if nulls else inside))
    fresh = new_facts(known, given, ordinal, identity)
    fresh, seen = kept_with(fresh if ordinal in old.columns else fresh.drop(ordinal), "fresh", n=F.count(F.lit(1)))
    if n := seen["n"]:
        blank = [F.col(f.name) if f.name in fresh.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema.fields]
        _put(fresh.select(*blank), folder, by, key, max(1, -(-n // file_rows)), "append")
    return n


def merge(spark: SparkSession, folder: str, rows: DataFrame, key: str, change: Callable[[DataFrame, DataFrame], DataFrame], file_rows: int = FILE_ROWS) -> int:
    """Puts change(old rows, new rows) in place of the partitions that the new rows meet; returns how many these are."""
    old, by = _opened(spark, folder)
    given = kept(_placed(rows, by, key), "given")
    met = _met(given, by)
    if met is None:
        return 0
    hidden = [c for c in by if PART.match(c)]
    before = old.where(met)
    after, seen = kept_with(_placed(change(before.drop(*hidden), given.drop(*hidden)).select(*[c for c in old.columns if c not in hidden]), by, key), "merged", n=F.count(F.lit(1)))
    places = [{tuple(r) for r in frame.select(*by).distinct().collect()} for frame in (before, given, after)]
    if strays := places[2] - places[0] - places[1]:
        raise ValueError(f"the change moves rows to partitions that it was not given: {sorted(map(str, strays))[:3]}")
    if places[2]:
        _put(after, folder, by, key, max(1, -(-seen["n"] // file_rows)), "dynamic")
    for gone in places[0] - places[2]:
        delete_path(spark, f"{folder}/" + "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(by, gone, strict=True)))
    return len(places[0] | places[1])
