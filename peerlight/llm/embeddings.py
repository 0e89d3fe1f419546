"""Embedding near-dedup: product-quantised inverted lists, sufficient probes and exact cosine rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlight.llm.common import connected_components, materialize, small_components


@dataclass
class Quantiser:
    """Coarse centres and the subspace codebooks of residuals, fitted on unit vectors."""

    centres: np.ndarray
    books: np.ndarray

    def codes(self, units: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of each vector and the length of what they miss."""
        rest = units - self.centres[cells]
        parts = rest.reshape(len(rest), *self.books.shape[::2])
        codes = np.empty((len(rest), len(self.books)), np.uint8)
        missed = np.zeros(len(rest))
        for m, book in enumerate(self.books):
            gaps = ((parts[:, m, None, :] - book[None]) ** 2).sum(axis=2)
            codes[:, m] = gaps.argmin(axis=1)
            missed += gaps.min(axis=1)
        return codes, np.sqrt(missed)

    def lists(self, units: np.ndarray) -> np.ndarray:
        return _nearest(units, self.centres)

    def probes(self, units: np.ndarray, reach: float) -> list[np.ndarray]:
        """Cells that can hold a vector within `reach` of each unit vector.

        A point within `reach` lies in another cell only if the plane halfway between both centres is
        within `reach`, so no such cell is left out.
        """
        between = np.sqrt(((self.centres[:, None, :] - self.centres[None]) ** 2).sum(axis=2))
        out: list[np.ndarray] = []
        for i in range(0, len(units), 1024):
            part = units[i : i + 1024]
            gaps = ((part[:, None, :] - self.centres[None]) ** 2).sum(axis=2)
            own = gaps.argmin(axis=1)
            plane = (gaps - gaps[np.arange(len(part)), own][:, None]) / np.maximum(2 * between[own], 1e-12)
            out += [np.flatnonzero(row) for row in (plane <= reach + 1e-9) | (between[own] == 0)]
        return out


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    for i in range(0, len(points), 4096):
        part = points[i : i + 4096]
        out[i : i + 4096] = (((centres**2).sum(axis=1)) - 2 * part @ centres.T).argmin(axis=1)
    return out


def _lloyd(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means centres from evenly spaced starting points."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        label = _nearest(points, centres)
        size = np.bincount(label, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, label, points)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def fit_quantiser(sample: np.ndarray, cells: int, subspaces: int, codewords: int = 32) -> Quantiser:
    centres = _lloyd(sample, max(1, min(cells, len(sample))))
    rest = (sample - centres[_nearest(sample, centres)]).reshape(len(sample), subspaces, -1)
    k = max(1, min(codewords, len(sample)))
    return Quantiser(centres, np.stack([_lloyd(rest[:, m], k) for m in range(subspaces)]))


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, by their largest component first, so no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
    return scaled / np.linalg.norm(scaled, axis=1)[:, None]


def near_duplicate_vectors(
    embeddings: DataFrame,
    least: float = 0.93,
    cells: int = 16,
    subspaces: int = 8,
    sample_rows: int = 8192,
    block_rows: int = 1024,
) -> DataFrame:
    """vec_id, n_links, component_id, kept and label of every vector.

    Rows are compared when their labels are equal and not NULL, by cosine in double precision. Vectors
    that are NULL, zero, hold a NULL or non-finite component, or differ in length from the fitted ones
    but not from each other, are handled without loss: the former link with nothing, the latter are
    compared within their own length. Rows with equal vectors and labels are one class whose rows all
    link, so copies are never paired. Repeated vec_ids count as other vectors; NULL ids are allowed and
    give a NULL component only where no id can be reached. Other columns are ignored.

    The index is fitted per vector length on at most `sample_rows` rows drawn by a hash; every class is
    indexed. A class visits each list that can hold a vector within reach, drops by table-lookup
    distance what cannot be within reach given each code's own error (so nothing is lost), and checks the
    rest exactly. A list of more than `block_rows` is cut in blocks; pairs of blocks are compared in
    tasks of their own, which return partial counts and a spanning forest, never pairs.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select("vec_id", "label", value.alias("v"))
    bad = F.lit(float("inf"))
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(F.when(F.isnan(x) | (F.abs(x) == bad), None).otherwise(F.abs(x)), F.lit(bad)))
    # In double precision a vector whose squares all vanish has length zero.
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.coalesce(x * x, F.lit(0.0)))
    usable = F.coalesce((size > 0) & (size < bad) & (squares > 0), F.lit(False)) & F.col("label").isNotNull()
    tagged = materialize(
        rows.withColumn("usable", usable).withColumn(
            "class", F.when(F.col("usable"), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.to_json(F.struct("v"))), 256))
        )
    )
    classes = materialize(
        tagged.filter("usable")
        .groupBy("class")
        .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("weight"))
        .withColumn("dim", F.size("v"))
    )
    counts, roots = [], []
    for dim, total in sorted((r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()):
        own = classes.filter(F.col("dim") == dim)
        draw = F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(min(1.0, sample_rows / total) * (1 << 30)) + 1
        sample = unit_vectors(np.array([r["v"] for r in own.filter(draw).orderBy("class").limit(2 * sample_rows).collect()] or [[1.0] * dim]))
        parts = max(m for m in range(1, min(subspaces, dim) + 1) if dim % m == 0)
        index = own.sparkSession.sparkContext.broadcast(fit_quantiser(sample, cells, parts))
        links = _links(own, index, least, block_rows)
        counts.append(links)
    linked = None
    for links in counts:
        linked = links if linked is None else linked.unionAll(links)
    if linked is None:
        return tagged.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"), "label")
    linked = materialize(linked)
    other = linked.groupBy("class").agg(F.sum("links").alias("links"))
    joined = connected_components(linked, "class", "root").withColumnRenamed("node", "class")
    known = classes.select("class", "weight").join(other, "class", "left").join(joined, "class", "left")
    per_class = known.select("class", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component"))
    out = materialize(tagged.select("vec_id", "label", "class").join(per_class, "class", "left"))
    first = out.filter("component is not null").groupBy("component").agg(F.min("vec_id").alias("first"))
    component = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("first"))
    return out.join(first, "component", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.col("component").isNull()).alias("kept"),
        "label",
    )


def _links(classes: DataFrame, index, least: float, block_rows: int) -> DataFrame:
    """(class, links, root) partial counts and spanning edges of all list blocks."""
    reach = float(np.sqrt(2 - 2 * least)) + 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row in the class's own list, and one query row per list it must visit."""
        q = index.value
        for batch in batches:
            units = unit_vectors(np.array(batch.column("v").to_pylist(), float))
            home = q.lists(units)
            codes, missed = q.codes(units, home)
            visit = q.probes(units, reach)
            row = np.repeat(np.arange(len(units)), [len(x) for x in visit])
            yield pa.record_batch(
                {
                    "class": batch.column("class").take(pa.array(row)),
                    "label": batch.column("label").take(pa.array(row)),
                    "weight": batch.column("weight").take(pa.array(row)),
                    "list": pa.array(np.concatenate(visit).astype(np.int32)),
                    "home": pa.array(home[row].astype(np.int32)),
                    "codes": pa.array([codes[i].tobytes() for i in row], pa.binary()),
                    "missed": pa.array(missed[row]),
                    "unit": pa.array([units[i].tobytes() for i in row], pa.binary()),
                }
            )

    schema = "class string, label string, weight long, list int, home int, codes binary, missed double, unit binary"
    placed = materialize(classes.select("class", F.col("label").cast("string").alias("label"), "weight", "v").mapInArrow(place, schema))
    blocks = placed.groupBy("label", "list").agg(
        F.ceil(F.count(F.when(F.col("home") == F.col("list"), 1)) / block_rows).cast("int").alias("list_blocks"),
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("query_blocks"),
    ).filter("list_blocks > 0")
    sized = placed.join(F.broadcast(blocks) if blocks.count() <= 100_000 else blocks, ["label", "list"])
    spot = F.xxhash64("class", F.lit(7))
    stored = sized.filter("home = list").select(
        "*", F.lit(False).alias("query"), F.pmod(spot, F.col("list_blocks")).cast("int").alias("lb"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"),
    )
    asked = sized.select(
        "*", F.lit(True).alias("query"), F.pmod(spot, F.col("query_blocks")).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("list_blocks") - 1)).alias("lb"),
    )
    columns = ["label", "list", "lb", "qb", "query", "class", "weight", "codes", "missed", "unit"]
    both = stored.select(*columns).unionByName(asked.select(*columns))

    def compare(table: pa.Table) -> pa.Table:
        q = index.value
        dim = q.centres.shape[1]
        parts = {}
        for side in (False, True):
            rows = table.filter(pc.equal(table.column("query"), side))
            parts[side] = (
                np.array(rows.column("class").to_pylist(), object),
                rows.column("weight").to_numpy(),
                np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(rows), -1),
                rows.column("missed").to_numpy(),
                np.frombuffer(b"".join(rows.column("unit").to_pylist())).reshape(len(rows), -1) if len(rows) else np.zeros((0, dim)),
            )
        names, weights, codes, missed, units = parts[False]
        asking, own_weight, _, _, asked_units = parts[True]
        cell = table.column("list")[0].as_py()
        order = np.argsort(names.astype(str)) if len(names) else []
        found_q: list[np.ndarray] = []
        found_l: list[np.ndarray] = []
        for i in range(0, len(asking), 128):
            part = asked_units[i : i + 128]
            rest = (part - q.centres[cell]).reshape(len(part), len(q.books), -1)
            far = np.zeros((len(part), len(names)))
            for m, book in enumerate(q.books):
                lookup = ((rest[:, m, None, :] - book[None]) ** 2).sum(axis=2)
                far += lookup[:, codes[:, m]]
            a, b = np.nonzero(np.sqrt(far) <= reach + missed[None, :] + 1e-6)
            near = np.einsum("ij,ij->i", part[a], units[b]) >= least
            found_q.append(a[near] + i)
            found_l.append(b[near])
        a = np.concatenate(found_q) if found_q else np.zeros(0, int)
        b = np.concatenate(found_l) if found_l else np.zeros(0, int)
        differ = asking[a] != names[b]
        a, b = a[differ], b[differ]
        links = np.bincount(a, weights[b], len(asking)).astype(np.int64)
        # A forest over queries and list rows keeps what is reachable in this block.
        label = small_components(len(asking) + len(names), a, b + len(asking))
        both_names = np.concatenate([asking, names])
        at = np.unique(np.concatenate([a, b + len(asking)]))
        return pa.table(
            {
                "class": pa.array(both_names[at].tolist(), pa.string()),
                "links": pa.array(np.where(at < len(asking), np.append(links, 0)[np.minimum(at, len(asking))], 0), pa.int64()),
                "root": pa.array(both_names[label[at]].tolist(), pa.string()),
            }
        )

    return both.groupBy("label", "list", "lb", "qb").applyInArrow(compare, "class string, links long, root string")
