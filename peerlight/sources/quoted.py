"""Quoted CSV with line breaks inside fields, read by many tasks per file."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A field with its closing quote (and what may follow it up to the comma), a bare field, or nothing.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
# A line that starts a record, or goes on after a closed quote, and ends within a quoted field.
_OPENS = re.compile(rf"(?:{_FIELD},)*+{_OPEN}\Z", re.S)
# A line that starts within a quoted field: what belongs to the field, up to its closing quote.
_REST = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+', re.S)


def _inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _REST.match(line)
        if closed is None:
            return True
        if closed.end() == len(line):
            return False
        at = closed.end() + 1
    return _OPENS.match(line, at) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the byte range they were read from; a range's lines follow each other within one task."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Consecutive lines of one byte range."""
    keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
    at = 0
    for (file, block), same in groupby(keys):
        n = sum(1 for _ in same)
        yield file, block, batch.column("value").slice(at, n)
        at += n


def range_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether each byte range starts within a quoted field.

    A range is read once for both answers. What it does to the state is constant (both starts end alike), a
    swap, or nothing, so running sums along the file's ranges give the state before each of them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        out = inside = False
        for batch in batches:
            for file, block, values in _runs(batch):
                if now != (file, block):
                    if now:
                        yield pa.record_batch({"file": [now[0]], "block": [now[1]], "out": [out], "ins": [inside]})
                    now, out, inside = (file, block), False, True
                for line in values.drop_null().to_pylist():
                    if out == inside:
                        out = inside = _inside_after(line, out)
                    else:
                        out, inside = _inside_after(line, out), _inside_after(line, inside)
        if now:
            yield pa.record_batch({"file": [now[0]], "block": [now[1]], "out": [out], "ins": [inside]})

    # Lines without a quote change nothing; only their range is passed on.
    quoted = F.when(F.contains("value", F.lit('"')), F.col("value")).alias("value")
    ends = lines.select("file", "block", quoted).mapInArrow(scan, "file string, block long, out boolean, ins boolean")
    order = Window.partitionBy("file").orderBy("block")
    swaps = F.sum((F.col("out") & ~F.col("ins")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    fixed = F.when(F.col("out") == F.col("ins"), F.pmod(F.col("out").cast("int") + F.col("swaps"), F.lit(2)))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.lag("swaps").over(order), F.lit(0))
    summed = ends.withColumn("swaps", swaps).withColumn("fixed", fixed)
    return summed.select("file", "block", (F.pmod(state, F.lit(2)) == 1).alias("inside"))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, head): every record of the CSV files below `path` as one string, without its line end.

    A record ends at a line end outside quotes, so a range of bytes can be cut into records once it is known
    whether it starts within a quoted field. That takes a first pass over the ranges; in the second each range
    starts at its first record, and the few records that cross ranges (at most one per range) are put
    together from their parts. Lines end with `\\n` or `\\r\\n`; quotes are doubled within fields, and a quote
    that does not start a field means nothing. `head` marks the first record of each file.

    Only the ranges that start within a field are known to the driver: some bytes for each, and a range holds
    `spark.sql.files.maxPartitionBytes`.
    """
    lines = _lines(spark, path)
    inner = range_states(lines).filter("inside").select("file", "block").collect()
    starts_inside = spark.sparkContext.broadcast({(row.file, row.block) for row in inner})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # kind: 0 a whole record, 1 the rest of an earlier range's record, 2 such a rest that ends here, 3 a beginning.
        now: tuple | None = None
        inside, whole, parts, seen = False, True, [], 0

        def rows(records: list[str], kinds: list[int], first: bool) -> pa.RecordBatch:
            n = len(records)
            heads = pa.array([first and i == 0 for i in range(n)], pa.bool_())
            return pa.record_batch(
                {
                    "file": pa.array([now[0]] * n, pa.string()),
                    "block": pa.array([now[1]] * n, pa.int64()),
                    "kind": pa.array(kinds, pa.int32()),
                    "head": heads,
                    "record": pa.array(records, pa.string()),
                }
            )

        for batch in batches:
            for file, block, values in _runs(batch):
                if now != (file, block):
                    if now and parts:
                        yield rows(["\n".join(parts)], [3 if whole else 1], now[1] == 0 and not seen)
                    now, parts, seen = (file, block), [], 0
                    inside = now in starts_inside.value
                    whole = not inside
                records, kinds = [], []
                if not inside and not pc.any(pc.match_substring(values, '"')).as_py():
                    records = values.to_pylist()
                    kinds = [0] * len(records)
                else:
                    for line in values.to_pylist():
                        inside = _inside_after(line, inside)
                        parts.append(line)
                        if not inside:
                            records.append(parts[0] if len(parts) == 1 else "\n".join(parts))
                            kinds.append(0 if whole else 2)
                            parts, whole = [], True
                if records:
                    yield rows(records, kinds, block == 0 and not seen)
                    seen += len(records)
        if now and parts:
            yield rows(["\n".join(parts)], [3 if whole else 1], now[1] == 0 and not seen)

    found = lines.select("value", "file", "block").mapInArrow(cut, "file string, block long, kind int, head boolean, record string")
    # Beginnings and rests: at most two per range.
    order = Window.partitionBy("file").orderBy("block", "kind")
    pieces = found.filter("kind > 0").withColumn("part", F.sum(F.when(F.col("kind") == 3, 1).otherwise(0)).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("block", "kind", "record", "head")))
    joined = pieces.groupBy("file", "part").agg(ordered.alias("pieces"))
    crossing = joined.select(
        F.array_join(F.transform("pieces", lambda p: p["record"]), "\n").alias("record"), F.exists("pieces", lambda p: p["head"]).alias("head")
    )
    records = found.filter("kind = 0").select("record", "head").unionAll(crossing)
    # Where records end with \r\n, that is also how line breaks within fields are written.
    plain = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), r"\r\n", "\n")
    text = F.when(F.endswith("record", F.lit("\r")), plain).otherwise(F.col("record"))
    text = F.when(F.col("head"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    return records.select(text.alias("record"), "head").filter("record <> '' or head")


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names as Spark's reader gives them, from the first file's header."""
    return spark.read.options(header=True, recursiveFileLookup=True, **options).csv(path).columns


def read_quoted_csv(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """CSV with header and line breaks in quoted fields, all columns as text, each file read by many tasks.

    The result is that of Spark's `multiLine` reader, which gives a whole file to one task. Files that
    compression makes unsplittable are still read by one task each.
    """
    options = {**(options or {}), "multiLine": True}
    names = _header(spark, path, options)
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    parsed = F.from_csv("record", F.lit(fields), {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()})
    rows = quoted_records(spark, path).filter(~F.col("head")).select(parsed.alias("row"))
    return rows.select(*[F.col("row")[name].alias(name) for name in names])
