"""Removal of repeated 400-byte strings: sparse suffix sorting around content-chosen anchors.

Every window of `length` bytes contains one anchor, the k-gram of least hash in it, so equal windows share
the anchor and their offset to it. Suffixes are sorted at anchors only: right contexts as they are, left
contexts backwards, by deep-shallow sorting. From both orders follow the common extensions of
any two places, hence the windows they share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import materialize
from peerlight.llm.ngrams import mix

# Bytes of a text that are hashed at a time; longer texts go in pieces that overlap by a window.
PIECE = 1 << 19
SHALLOW, SYMBOL = 64, 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for base in (_BASE, _INVERSE):
            _POWERS.append(np.concatenate([[np.uint64(1)], np.cumprod(np.full(PIECE, base))]))
    return _POWERS[0], _POWERS[1]


def anchors(text: bytes, length: int, k: int) -> Iterator[tuple[int, int, int, int]]:
    """(hash of the anchor's k-gram, anchor, first and last start of the windows it stands for)."""
    for base in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
        part = text[base : base + PIECE]
        if len(part) < length:
            return
        yield from _piece_anchors(part, base, length, k)


def _piece_anchors(part: bytes, base: int, length: int, k: int) -> Iterator[tuple[int, int, int, int]]:
    power, inverse = _powers()
    raw = np.frombuffer(part, np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(raw)
    total = np.concatenate([[np.uint64(0)], np.cumsum(raw * power[:n])])
    gram = mix((total[k:] - total[:-k]) * inverse[: n - k + 1])
    width = length - k + 1
    packed = ((gram >> np.uint64(20)) << np.uint64(20)) | np.arange(len(gram), dtype=np.uint64)
    padded = np.full(-(-len(packed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    at = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], count) - 1
    keys = gram[at[first]].astype(np.int64)
    yield from zip(keys.tolist(), (at[first] + base).tolist(), (first + base).tolist(), (last + base).tolist())


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def deep_shallow(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and each one's common prefix with the one before it.

    Multikey quicksort on symbols of 16 bytes orders them to the shallow depth; strings that agree so far
    go to a blind trie.
    """
    order: list[int] = []

    def shallow(group: list[int], depth: int) -> None:
        stack = [(group, depth)]
        while stack:
            group, depth = stack.pop()
            if len(group) <= 1 or depth < 0:
                order.extend(group)
                continue
            if depth >= SHALLOW:
                order.extend(_blind_trie(strings, group, depth))
                continue
            pivot = strings[group[len(group) // 2]][depth : depth + SYMBOL]
            less, same, more = [], [], []
            for i in group:
                symbol = strings[i][depth : depth + SYMBOL]
                (less if symbol < pivot else more if symbol > pivot else same).append(i)
            ended = [i for i in same if len(strings[i]) < depth + SYMBOL]
            going = [i for i in same if len(strings[i]) >= depth + SYMBOL]
            stack += [(more, depth), (going, depth + SYMBOL)]
            if ended:
                # Equal to the end: any order is right.
                stack.append((ended, -1))
            stack.append((less, depth))

    shallow(list(range(len(strings))), 0)
    prefix = [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return order, prefix


def _blind_trie(strings: list[bytes], group: list[int], depth: int) -> list[int]:
    """Order of strings that share their first `depth` bytes.

    A node is [depth, branches by the byte there (-1 for the end)]; a leaf is a list of equal strings.
    Going down looks at branching bytes only; one comparison then tells where the string leaves.
    """

    def byte(i: int, at: int) -> int:
        return strings[i][at] if at < len(strings[i]) else -1

    root: tuple | list = [group[0]]
    for i in group[1:]:
        node = root
        while isinstance(node, tuple):
            node = node[1].get(byte(i, node[0])) or next(iter(node[1].values()))
        other = node[0]
        leave = depth + common_prefix(strings[i][depth:], strings[other][depth:])
        if leave == len(strings[i]) == len(strings[other]):
            node.append(i)
            continue
        parent, node = None, root
        while isinstance(node, tuple) and node[0] < leave:
            parent, node = node, node[1][byte(i, node[0])]
        if isinstance(node, tuple) and node[0] == leave:
            node[1][byte(i, leave)] = [i]
            continue
        split = (leave, {byte(other, leave): node, byte(i, leave): [i]})
        if parent is None:
            root = split
        else:
            parent[1][byte(i, parent[0])] = split
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def _extensions(strings: list[bytes]) -> np.ndarray:
    """Common prefix of every two strings, from their sorted order."""
    order, prefix = deep_shallow(strings)
    n = len(order)
    sorted_prefix = np.array(prefix)
    out = np.zeros((n, n), np.int64)
    for x in range(n - 1):
        out[x, x + 1 :] = np.minimum.accumulate(sorted_prefix[x + 1 :])
    out += out.T
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return out[np.ix_(place, place)]


def shared_windows(members: list[tuple[bytes, int, int]], length: int) -> list[list[tuple[int, int]]]:
    """Per member (content, anchor within it, last window start within it): ranges of window starts that
    another member holds at the same offset to the anchor."""
    if len(members) == 2:
        (a, x, _), (b, y, _) = members
        right = np.array([[0, common_prefix(a[x:], b[y:])]])
        left = np.array([[0, common_prefix(a[:x][::-1], b[:y][::-1])]])
        right, left = np.vstack([right, right[:, ::-1]]), np.vstack([left, left[:, ::-1]])
    else:
        right = _extensions([c[at:] for c, at, _ in members])
        left = _extensions([c[:at][::-1] for c, at, _ in members])
    out = []
    for i, (_, at, last) in enumerate(members):
        high = np.minimum(left[i], at)
        low = np.maximum(length - right[i], 0)
        starts, ends = np.maximum(at - high, 0), np.minimum(at - low, last)
        good = (low <= high) & (starts <= ends)
        good[i] = False
        ranges = sorted(set(zip(starts[good].tolist(), ends[good].tolist())))
        out.append(merged(ranges))
    return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted closed ranges with overlapping and adjacent ones joined."""
    out: list[tuple[int, int]] = []
    for low, high in ranges:
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _uid() -> list[Column]:
    """Two hashes that name a row by its id and its whole text."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64("doc_id", text).alias("u1"), F.xxhash64(text, F.lit(1), "doc_id").alias("u2")]


_PIECES = "key long, digest long, weight long, u1 long, u2 long, anchor long, low long, high long, content binary"


def repeated_windows(docs: DataFrame, length: int = 400, k: int = 64, most: int = 256) -> DataFrame:
    """(u1, u2, low, high): ranges of starts of the windows of each text that also start elsewhere.

    Pieces (the windows of one anchor occurrence) with an anchor that occurs once are dropped by a count.
    Pieces equal as a whole are settled by their digests with partial sums, so a passage in a third of
    all documents is one row per digest afterwards. What differs is compared in groups of one anchor; a
    group of more than `most` different pieces is cut into finer pieces, keyed by the bytes all their
    windows share, down to single windows, which a count settles. So no task holds more than `most`
    pieces of an anchor, and nothing is left out.
    """
    grain = docs.select(*_uid(), "text")
    found = grain.filter(F.octet_length("text") >= length).mapInArrow(
        _emit_anchors(length, k), "u1 long, u2 long, key long, digest long, anchor long, low long, high long"
    )
    # Written first, so that both sides of the join are dealt anew and Spark may split a hot key.
    often = materialize(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"))
    places = materialize(found.join(often, "key", "left_semi"))
    place = F.struct("u1", "u2", "anchor", "low", "high")
    kinds = materialize(places.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("weight"), F.min(place).alias("p")))
    marks = places.join(kinds.filter("weight > 1").select("key", "digest"), ["key", "digest"], "left_semi").select(
        "u1", "u2", "low", "high"
    )
    sizes = materialize(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1"))
    wanted = (
        kinds.join(sizes, "key")
        .select("p.u1", "p.u2", F.struct("key", "digest", "weight", "p.anchor", "p.low", "p.high").alias("w"))
        .groupBy("u1", "u2")
        .agg(F.collect_list("w").alias("wanted"))
    )
    wanted = materialize(wanted)
    rows = materialize(_with(grain, wanted).dropDuplicates(["u1", "u2"]).mapInArrow(_emit_content(length), _PIECES))
    for width in (32, 4, 1, 0):
        sizes = rows.select("key", "digest").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
        small = rows.join(sizes.filter(F.col("many") <= most).select("key"), "key", "left_semi")
        marks = marks.unionAll(
            small.dropDuplicates(["key", "digest"])
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(_compare(length), "u1 long, u2 long, low long, high long")
        )
        hot = rows.join(sizes.filter(F.col("many") > most).select("key"), "key", "left_semi")
        if not width or hot.isEmpty():
            break
        cut = materialize(hot.mapInArrow(_cut(length, width), _PIECES))
        total = cut.groupBy("key", "digest").agg(F.sum("weight").alias("total"))
        twice = total.filter("total > 1").select("key", "digest")
        marks = marks.unionAll(cut.join(twice, ["key", "digest"], "left_semi").select("u1", "u2", "low", "high"))
        rows = materialize(cut.join(total, ["key", "digest"]).drop("weight").withColumnRenamed("total", "weight").select(*rows.columns))
    return marks


# Texts are picked by broadcast keys up to this many (16 bytes each), else by a shuffle.
BROADCAST_KEYS = 1_000_000


def _with(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """Inner join on the text names, moving only texts that have a row."""
    if rows.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(rows.select("u1", "u2")), ["u1", "u2"], "left_semi")
    return texts.join(rows, ["u1", "u2"])


def _emit_anchors(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u1, u2 = batch.column("u1").to_numpy(), batch.column("u2").to_numpy()
            out: list[tuple[int, ...]] = []
            row: list[int] = []
            for i, text in enumerate(batch.column("text")):
                raw = text.as_buffer().to_pybytes()
                for key, at, low, high in anchors(raw, length, k):
                    digest = xxhash.xxh3_64_intdigest(raw[low : high + length], at - low) - (1 << 63)
                    out.append((key, digest, at, low, high))
                    row.append(i)
                if len(out) > 100_000:
                    yield _anchor_rows(u1, u2, row, out)
                    out, row = [], []
            if out:
                yield _anchor_rows(u1, u2, row, out)

    return run


def _anchor_rows(u1, u2, row, out) -> pa.RecordBatch:
    columns = np.array(out, np.int64)
    names = ["key", "digest", "anchor", "low", "high"]
    return pa.record_batch({"u1": u1[row], "u2": u2[row]} | {name: columns[:, i] for i, name in enumerate(names)})


def _emit_content(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for text, u1, u2, wanted in zip(*(batch.column(c) for c in ("text", "u1", "u2", "wanted"))):
                raw = text.as_buffer().to_pybytes()
                for w in wanted.as_py():
                    content = raw[w["low"] : w["high"] + length]
                    rows.append(w | {"u1": u1.as_py(), "u2": u2.as_py(), "content": content})
                    size += len(content)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _PIECE_ROWS)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _PIECE_ROWS)

    return run


_PIECE_ROWS = pa.schema(
    [(name, pa.int64()) for name in ("key", "digest", "weight", "u1", "u2", "anchor", "low", "high")] + [("content", pa.binary())]
)


def _compare(length: int):
    """Marks of the pieces of each anchor, which follow each other."""

    def settle(group: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        members = [(g["content"], g["anchor"] - g["low"], g["high"] - g["low"]) for g in group]
        for g, ranges in zip(group, shared_windows(members, length)):
            for low, high in ranges:
                yield g["u1"], g["u2"], g["low"] + low, g["low"] + high

    def batch_of(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        columns = np.array(rows, np.int64)
        return pa.record_batch({name: columns[:, i] for i, name in enumerate(("u1", "u2", "low", "high"))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        out: list[tuple[int, int, int, int]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if group and row["key"] != group[0]["key"]:
                    out.extend(settle(group))
                    group = []
                group.append(row)
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if group:
            out.extend(settle(group))
        if out:
            yield batch_of(out)

    return run


def _cut(length: int, width: int):
    """Pieces of at most `width` windows, on a grid of offsets to the anchor, keyed by the bytes all windows of the
    grid cell share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                at, low, high, content = row["anchor"], row["low"], row["high"], row["content"]
                for cell in range((at - high) // width, (at - low) // width + 1):
                    first, last = max(low, at - (cell + 1) * width + 1), min(high, at - cell * width)
                    core = content[at - cell * width - low : at - (cell + 1) * width + 1 - low + length]
                    key = xxhash.xxh3_64_intdigest(core + cell.to_bytes(8, "little", signed=True), row["key"] & (2**64 - 1))
                    own = content[first - low : last - low + length]
                    digest = xxhash.xxh3_64_intdigest(own, at - first)
                    rows.append(row | {"key": key - (1 << 63), "digest": digest - (1 << 63), "low": first, "high": last, "content": own})
                if len(rows) > 5_000:
                    yield pa.RecordBatch.from_pylist(rows, _PIECE_ROWS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _PIECE_ROWS)

    return run


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes (kept) of every row.

    A byte goes when a string of `length` bytes over it also starts anywhere else, judged on the input; matches
    never cross rows. NULL and empty texts have no bytes; repeated rows are separate places, so both go; rows that
    share only a doc_id stay apart. Texts shorter than `length` stay whole. Other columns are ignored.
    """
    marks = repeated_windows(docs, length)
    ranges = materialize(marks.groupBy("u1", "u2").agg(F.collect_set(F.struct("low", "high")).alias("ranges")))
    rows = docs.select("doc_id", *_uid(), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("ranges").to_pylist()):
                raw, cuts = text.as_buffer().to_pybytes(), []
                for low, high in sorted((r["low"], r["high"] + length - 1) for r in found or []):
                    cuts.append((low, high))
                cuts = merged(cuts)
                spans.append(len(cuts))
                removed.append(sum(high - low + 1 for low, high in cuts))
                edges = [0, *[x for low, high in cuts for x in (low, high + 1)], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pc.cast(pc.binary_length(batch.column("text")), pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(spans, pa.int64()),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    if ranges.count() <= BROADCAST_KEYS:
        names = F.broadcast(ranges.select("u1", "u2"))
        whole = rows.join(names, ["u1", "u2"], "left_anti").select(
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.lit(0).cast("long").alias("n_removed"),
            F.lit(0).cast("long").alias("n_spans"),
            F.encode("text", "UTF-8").alias("kept"),
        )
        touched = rows.join(names, ["u1", "u2"], "left_semi").join(ranges, ["u1", "u2"])
        return touched.select("doc_id", "text", "ranges").mapInArrow(run, schema).unionAll(whole)
    return rows.join(ranges, ["u1", "u2"], "left").select("doc_id", "text", "ranges").mapInArrow(run, schema)
