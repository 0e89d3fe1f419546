"""Benchmark decontamination: Wu-Manber search for all word windows of a benchmark in every document."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import bound_batches, carried, materialize, passed, releasing, slices, with_carried, words_of


class WuManber:
    """Word windows of one length, found by block shifts, suffix buckets and direct comparison.

    The block is the last two words under the search position (one for windows of one word). A block
    found in no window lets the search jump over `length - 1` positions.
    """

    def __init__(self, length: int, windows: list[tuple[tuple[bytes, ...], list[str]]]):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]] = defaultdict(list)
        for window, items in windows:
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            self.buckets[window[-self.block :]].append((window, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start and item ids of every occurrence."""
        shift, jump, length, block = self.shift.get, self.jump, self.length, self.block
        end, n = length, len(words)
        while end <= n:
            last = tuple(words[end - block : end])
            step = shift(last, jump)
            if step:
                end += step
                continue
            first = words[end - length]
            for window, items in self.buckets[last]:
                if window[0] == first and list(window) == words[end - length : end]:
                    yield end - length, items
            end += 1


def searchers(rows: list[tuple[list[bytes], list[str]]]) -> list[WuManber]:
    """One searcher per window length."""
    by_length: dict[int, list] = defaultdict(list)
    for window, items in rows:
        by_length[len(window)].append((tuple(window), items))
    return [WuManber(n, windows) for n, windows in sorted(by_length.items())]


def covered(spans: list[tuple[int, int]]) -> int:
    """Positions inside any of the half-open spans."""
    total, reach = 0, 0
    for low, high in sorted(spans):
        total += max(0, high - max(low, reach))
        reach = max(reach, high)
    return total


def benchmark_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Distinct windows (words, items): `size` consecutive words of an item, or all words of a shorter one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                windows: list[bytes] = []
                ids: list[str | None] = []
                for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                    words = words_of(text)
                    own = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} - {b""}
                    windows.extend(own)
                    ids.extend([item] * len(own))
                yield pa.record_batch({"words": pa.array(windows, pa.binary()), "item": pa.array(ids, pa.string())})

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(releasing(run), "words binary, item string").groupBy("words").agg(F.collect_set("item").alias("items"))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, slice_bytes: int = 32 << 20, carry: list[str] | None = None
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any window), items (sorted ids as strings).

    The windows are counted in bytes first and cut by hash into slices of about `slice_bytes`, so what
    is sent to the executors is bounded; each slice is one more narrow pass over the rows of a
    partition, and no document is ever shuffled. NULL and empty texts have no words; NULL item ids
    hit words but are no item; repeated rows stay. Columns named by `carry` come along as the struct
    `carried`; all others are ignored.
    """
    bound_batches(docs.sparkSession)
    windows = materialize(benchmark_windows(benchmark, size))
    item_bytes = F.expr("aggregate(transform(items, x -> octet_length(x) + 8), 0L, (a, x) -> a + x)")
    total = windows.agg(F.sum(F.octet_length("words") + F.coalesce(item_bytes, F.lit(0)))).first()[0] or 0
    parts = 1 + total // slice_bytes
    out = docs.select(
        "doc_id",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.expr("CAST(array() AS array<bigint>)").alias("spans"),
        F.expr("CAST(array() AS array<string>)").alias("items"),
        *carried(carry),
    )
    counted = with_carried("doc_id long, n_words long, n_hit long, items array<string>", out)
    for part in range(parts):
        rows = windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).collect()
        patterns = docs.sparkSession.sparkContext.broadcast([(r["words"].split(), r["items"]) for r in rows])
        last = part == parts - 1
        out = out.mapInArrow(_search(patterns, last), counted if last else out.schema)
    return out


def _search(patterns, last: bool):
    """One narrow pass that adds the spans and items of the broadcast windows to each row.

    The last one counts them instead: a pass of its own would be one more Python process per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = searchers(patterns.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                counts: list[int] = []
                spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                for i, text in enumerate(batch.column("text").to_pylist()):
                    words = words_of(text)
                    counts.append(len(words))
                    own: set[str] = set()
                    for searcher in found:
                        for start, ids in searcher.find(words):
                            if spans[i] and start <= spans[i][-1] and start >= spans[i][-2]:
                                spans[i][-1] = max(spans[i][-1], start + searcher.length)
                            else:
                                spans[i] += (start, start + searcher.length)
                            own.update(ids)
                    items[i].extend(own)
                count = {"n_words": pa.array(counts, pa.int64())}
                if last:
                    count["n_hit"] = pa.array([covered(list(zip(s[::2], s[1::2]))) for s in spans], pa.int64())
                    items = [sorted(set(x)) for x in items]
                else:
                    count = {"text": batch.column("text")} | count | {"spans": pa.array(spans, pa.list_(pa.int64()))}
                out = {"doc_id": batch.column("doc_id")} | count | {"items": pa.array(items, pa.list_(pa.string()))}
                yield passed(batch, out)

    return releasing(run)
