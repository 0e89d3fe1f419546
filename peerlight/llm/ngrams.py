"""N-gram Jaccard join: MinHash bands find candidate groups, full n-gram sets decide every link."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import WORD_BYTES, connected_components, materialize, releasing, slices, small_components

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def choose_bands(least: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have so that a pair at `least` shares one with probability `recall`."""
    best = (ceil(log(1 - recall) / log(1 - least)), 1)
    for rows in range(2, max_hashes + 1):
        bands = ceil(log(1 - recall) / log(1 - least**rows))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def shingle_sets(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, and where each text's begin and end.

    A text of fewer than n words, but not none, is one n-gram; a text without words has none.
    """
    blocks = [(t or "").encode().translate(WORD_BYTES) for t in texts]
    flat = np.frombuffer(b" ".join([*blocks, b" "]), np.uint8)
    inside = flat != 32
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.cumsum([0, *[len(b) + 1 for b in blocks]])
    words = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    length = ends - starts
    first = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(first, length)
    power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(length.max()), _BASE))])
    word = mix(np.add.reduceat((flat[inside].astype(np.uint64) + np.uint64(1)) * power[place], first) + length.astype(np.uint64))
    doc = np.repeat(np.arange(len(texts)), words)
    # A short text is filled up with marks, so its words count as often and in the order they stand.
    short = (words > 0) & (words < n)
    fill = np.where(short, n - words, 0)
    at = np.repeat(np.cumsum(words), fill)
    word = np.insert(word, at, np.uint64(1))
    doc = np.insert(doc, at, np.repeat(np.arange(len(texts)), fill))
    gram = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for k in range(n):
        gram += word[k : k + len(gram)] * power_of(k)
    whole = doc[: len(gram)] == doc[n - 1 :]
    gram, doc = mix(gram[whole]), doc[: len(gram)][whole]
    order = np.lexsort((gram, doc))
    gram, doc = gram[order], doc[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    gram, doc = gram[new], doc[new]
    return gram, np.searchsorted(doc, np.arange(len(texts) + 1))


def power_of(k: int) -> np.uint64:
    return np.uint64(pow(int(_BASE) | 1, 2 * k + 1, 1 << 64))


def band_hashes(grams: np.ndarray, cuts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes [set, band] of sets that are not empty."""
    seeds = np.random.default_rng(20240601).integers(0, 1 << 63, 2 * bands * rows, np.uint64) | np.uint64(1)
    out = np.zeros((len(cuts) - 1, bands), np.uint64)
    # Pieces of some thousand n-grams stay in the cache while all hash functions pass over them.
    low = 0
    while low < len(cuts) - 1:
        high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + 16_384, side="right")) - 1)
        part, own = grams[cuts[low] : cuts[high]], cuts[low:high] - cuts[low]
        for band in range(bands):
            total = np.full(high - low, np.uint64(band))
            for row in range(rows):
                k = 2 * (band * rows + row)
                total = total * seeds[k] + np.minimum.reduceat(part * seeds[k] + seeds[k + 1], own)
            out[low:high, band] = mix(total)
        low = high
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, fingerprint of the n-gram set, n_shingles, band hashes); no words: NULL fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                grams, cuts = shingle_sets(batch.column("text").to_pylist(), n)
                sizes = np.diff(cuts)
                some = sizes > 0
                prints = [hashlib.md5(grams[a:b].tobytes()).digest() if b > a else None for a, b in zip(cuts, cuts[1:])]
                hashes = band_hashes(grams, np.append(cuts[:-1][some], len(grams)), bands, rows)
                ends = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id"),
                        "fp": pa.array(prints, pa.binary()),
                        "n_shingles": pa.array(sizes.astype(np.int64)),
                        "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.ravel().astype(np.int64))),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(releasing(run), "doc_id long, fp binary, n_shingles long, bands array<long>")


def ngram_jaccard_join(
    docs: DataFrame,
    n: int = 5,
    least: float = 0.8,
    recall: float = 0.9999,
    max_hashes: int = 128,
    block_rows: int = 1024,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """doc_id, n_shingles, class_id, n_links, component_id, kept of every document.

    Documents with equal n-gram sets are one class (class_id: its smallest doc_id), so copies are never
    paired. Classes that share a MinHash band are tied to the smallest class of the bucket; the tied
    groups are only candidates. Inside a group every pair of classes is checked on full sets, in
    blocks of at most `block_rows` classes and about `block_bytes`, a task per pair of blocks, which returns counts
    and a spanning forest instead of pairs. n_links counts the other documents at `least` or more
    (those of the same class included), component_id is the smallest doc_id reachable, and
    kept marks it; a pair at `least` is missed with probability 1 - `recall` at most.

    Texts without words (NULL, empty) link with nothing and are kept. Texts of fewer than n words are one
    n-gram. Repeated rows are documents of their own that link with each other; NULL ids count as
    documents but never name a group that has another id. Other columns are ignored.
    """
    bands, rows = choose_bands(least, recall, max_hashes)
    signed = materialize(signatures(docs, n, bands, rows))
    classes = materialize(
        signed.filter("fp is not null")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.count(F.lit(1)).alias("weight"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )
    buckets = classes.select("fp", F.posexplode("bands").alias("band", "hash")).select("fp", F.xxhash64("band", "hash").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).filter("first <> last")
    # Written first, so that both sides of the join are dealt anew and Spark may split a hot bucket.
    ties = buckets.join(materialize(shared.select("bucket", "first")), "bucket").filter("fp <> first")
    groups = connected_components(ties, "fp", "first")
    members = materialize(
        groups.withColumnRenamed("node", "fp").join(classes.select("fp", "class_id", "weight", "n_shingles"), "fp")
    )
    blocks = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("n_shingles") * 8 / block_bytes)).cast("int").alias("blocks")
    )
    placed = members.join(blocks, "component").select(
        "fp", "component", "weight", "class_id", "blocks", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block")
    )
    sets = _sets_of(docs, members, n)
    pairs = placed.join(sets, "fp").select(
        "fp", "component", "weight", "block", "grams", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    links = materialize(
        pairs.select(
            "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp", "weight", "grams"
        )
        .groupBy("component", "low", "high")
        .applyInArrow(_verify(least), "fp binary, links long, root binary")
    )
    counted = links.groupBy("fp").agg(F.sum("links").alias("links"))
    joined = connected_components(links, "fp", "root").withColumnRenamed("node", "fp")
    known = materialize(
        classes.select("fp", "class_id", "weight")
        .join(counted, "fp", "left")
        .join(joined, "fp", "left")
        .select("fp", "class_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "fp").alias("component"))
    )
    first = known.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = known.join(first, "component").drop("component")
    component = F.coalesce("component_id", "doc_id")
    return signed.select("doc_id", "fp", "n_shingles").join(named, "fp", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("fp").isNull() | F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).alias("kept"),
    )


# Ids of group members are broadcast up to this many (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _sets_of(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """(fp, grams): n-gram sets of the texts that represent a member class, made again from the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                grams, cuts = shingle_sets(batch.column("text").to_pylist(), n)
                parts = [grams[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                prints = [hashlib.md5(p).digest() for p in parts]
                yield pa.record_batch({"fp": pa.array(prints, pa.binary()), "grams": pa.array(parts, pa.binary())})

    ids = members.filter("class_id is not null").select(F.col("class_id").alias("doc_id")).distinct()
    ids = F.broadcast(ids) if members.count() <= BROADCAST_IDS else ids
    named = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    texts = named.unionAll(docs.select("doc_id", "text").filter("doc_id is null"))
    return texts.mapInArrow(releasing(run), "fp binary, grams binary")


def _verify(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Links between the classes of two blocks (or within one), decided on their full sets."""
        rows = {fp: i for i, fp in enumerate(table.column("fp").to_pylist())}
        keep = sorted(rows.values())
        names = [table.column("fp")[i].as_py() for i in keep]
        weights = table.column("weight").to_numpy()[keep]
        block = table.column("block").to_numpy()[keep]
        sets = [np.frombuffer(table.column("grams")[i].as_py(), np.uint64) for i in keep]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        size = np.array([len(s) for s in sets])
        left = np.flatnonzero(block == low)
        right = np.flatnonzero(block == high)
        common = _intersections(sets, left, right)
        union = size[left][:, None] + size[right][None] - common
        i, j = np.nonzero(common >= least * union - 1e-9)
        a, b = left[i], right[j]
        if low == high:
            a, b = a[a < b], b[a < b]
        links = np.bincount(a, weights[b], len(names)) + np.bincount(b, weights[a], len(names))
        label = small_components(len(names), a, b)
        at = np.flatnonzero(links)
        return pa.table(
            {
                "fp": pa.array([names[x] for x in at], pa.binary()),
                "links": pa.array(links[at].astype(np.int64)),
                "root": pa.array([names[label[x]] for x in at], pa.binary()),
            }
        )

    return run


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 2048) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    if len(sets) == 2:
        return np.array([[len(np.intersect1d(sets[i], sets[j], True)) for j in right] for i in left]).reshape(len(left), len(right))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only n-grams of several sets can meet.
    used = np.cumsum(times > 1) - 1
    several = times[column] > 1
    owner, column = owner[several], used[column[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    place_left = np.full(len(sets), -1)
    place_left[left] = np.arange(len(left))
    place_right = np.full(len(sets), -1)
    place_right[right] = np.arange(len(right))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        own, col = owner[a:b], column[a:b] - start
        x = np.zeros((len(left), width), np.float32)
        y = np.zeros((len(right), width), np.float32)
        on = place_left[own] >= 0
        x[place_left[own[on]], col[on]] = 1
        on = place_right[own] >= 0
        y[place_right[own[on]], col[on]] = 1
        out += x @ y.T
    return out
