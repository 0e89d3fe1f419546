"""Feature snapshots that are brought up to date year by year."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.names import DEFAULT_REPORT_YEAR, REPORT_YEAR
from peerlight.sources import (
    column_kinds,
    list_datasets,
    load_drug_data,
    load_payments,
    load_prescribers,
    load_recipient_data,
    materialize,
    normalize_prescriber_schema,
    read_raw_csv,
    snapshot,
    types_of_kinds,
)
from peerlight.sources.loaders import QUOTED_MULTILINE

MANIFEST = "dataset string, path string, year int, files string, header string, kinds map<string,int>, settings string"
# Sources by file prefix: whether undated files count, and reader options.
DATASETS = {
    "prescribers": (False, None),
    "payments": (False, QUOTED_MULTILINE),
    "prescriber_drug": (False, None),
    "recipient_profile": (True, None),
}


def _found_datasets(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    found = []
    for prefix, (undated, _) in DATASETS.items():
        for path, year in list_datasets(spark, root, prefix, allow_undated=undated).items():
            found.append((prefix, path, year or DEFAULT_REPORT_YEAR))
    return found


def source_manifest(spark: SparkSession, root: str, old: dict[str, dict] | None = None, settings: str = "") -> dict[str, dict]:
    """What the CSV data sets below `root` look like, by path: files with length and time, header, kinds of values.

    Files are listed, not read. Only data sets that `old` does not hold unchanged are opened, and only the
    prescriber files among them, whose extra columns have their types inferred, are scanned once.
    """
    manifest = {}
    for prefix, path, year in _found_datasets(spark, root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        names = files.select(F.concat_ws(" ", "path", "length", F.unix_micros("modificationTime")).alias("name"))
        digest = names.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("name")), "\n"), 256)).first()[0]
        known = (old or {}).get(path)
        if known and known["files"] == digest:
            manifest[path] = {**known, "settings": settings}
            continue
        frame = read_raw_csv(spark, path, DATASETS[prefix][1]) if prefix != "payments" else spark.read.options(header=True, **QUOTED_MULTILINE).csv(path)
        if prefix == "prescribers":
            frame = normalize_prescriber_schema(frame)
        manifest[path] = {
            "dataset": prefix,
            "path": path,
            "year": year,
            "files": digest,
            "header": "\t".join(frame.columns),
            "kinds": column_kinds([frame]) if prefix == "prescribers" else {},
            "settings": settings,
        }
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict[str, dict] | None:
    try:
        return {row.path: row.asDict() for row in spark.read.schema(MANIFEST).json(f"{path}_manifest").collect()}
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_manifest(spark: SparkSession, path: str, manifest: dict[str, dict]) -> None:
    names = [part.split(" ")[0] for part in MANIFEST.split(", ")]
    rows = spark.createDataFrame([tuple(entry[n] for n in names) for entry in manifest.values()], MANIFEST)
    rows.coalesce(1).write.mode("overwrite").json(f"{path}_manifest")


def changed_years(old: dict[str, dict], new: dict[str, dict]) -> set[int]:
    """Years with a data set that is new, gone, or whose files or header differ."""
    years = set()
    for path in old.keys() | new.keys():
        a, b = old.get(path), new.get(path)
        if a is None or b is None or (a["files"], a["header"]) != (b["files"], b["header"]):
            years.add((b or a)["year"])
    return years


def _types(manifest: dict[str, dict]) -> dict[str, str]:
    return types_of_kinds([entry["kinds"] for entry in manifest.values() if entry["dataset"] == "prescribers"])


def _headers(manifest: dict[str, dict]) -> set[tuple[str, str]]:
    """Columns of every source over all its years."""
    return {(entry["dataset"], column) for entry in manifest.values() for column in entry["header"].split("\t")}


def refresh_features(spark: SparkSession, root: str, path: str, sample_fraction: float = 1.0) -> tuple[DataFrame, int, list[int]]:
    """The feature snapshot brought up to date, its row count, and the years that were computed.

    A manifest beside the snapshot tells which years' inputs changed since it was written; only their
    partitions are computed and replaced. Everything is built anew when there is no manifest or snapshot,
    when the sampling differs, when a column came, went or changed its type over all years, or when a year
    has no rows any more; so the result always equals a full build. The manifest is written last: after a
    failure the same years count as changed again.
    """
    from peerlight.plans.featured import _snapshot_or_none, featured_from_sources

    settings = f"sample_fraction={sample_fraction}"
    old, existing = read_manifest(spark, path), _snapshot_or_none(spark, path)
    if old is not None and {entry["settings"] for entry in old.values()} != {settings}:
        old = None
    new = source_manifest(spark, root, old, settings)
    types, every = _types(new), {entry["year"] for entry in new.values()}

    def build(years: set[int] | None) -> DataFrame:
        return featured_from_sources(
            materialize(load_prescribers(spark, root, years=years, types=types)),
            load_payments(spark, root, years=years),
            load_drug_data(spark, root, years=years),
            load_recipient_data(spark, root, years=years),
            sample_fraction,
        )

    if old is not None and existing is not None and _types(old) == types and _headers(old) == _headers(new):
        years = changed_years(old, new)
        if not years:
            return existing, existing.count(), []
        if years < every:
            part = materialize(build(years))
            gone = years - {row[0] for row in part.select(REPORT_YEAR).distinct().collect()}
            if not gone and dict(part.dtypes) == dict(existing.dtypes):
                columns = [c for c in existing.columns if c != REPORT_YEAR] + [REPORT_YEAR]
                writer = part.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy(REPORT_YEAR).parquet(path)
                write_manifest(spark, path, new)
                saved = spark.read.schema(existing.schema).parquet(path)
                return saved, saved.count(), sorted(years)
    saved, rows = snapshot(build(None), path, partition_by=[REPORT_YEAR])
    write_manifest(spark, path, new)
    return saved, rows, sorted(every)
