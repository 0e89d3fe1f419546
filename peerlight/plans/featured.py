"""Feature build: raw sources to one featured row per provider-year."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from peerlight.names import REPORT_YEAR
from peerlight.operators.assemble import (
    aggregate_drug_data,
    aggregate_payments,
    aggregate_recipient_data,
    join_data,
)
from peerlight.operators.clean import (
    clean_drug_data,
    clean_payments,
    clean_prescribers,
    clean_recipient_data,
)
from peerlight.operators.features import build_features
from peerlight.plans.incremental import read_manifest, refresh_features, source_manifest, write_manifest
from peerlight.sources import (
    has_multi_year_raw_data,
    load_drug_data,
    load_featured_data,
    load_payments,
    load_prescribers,
    load_recipient_data,
    materialize,
    snapshot,
)


def sample_rows(df: DataFrame, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Bernoulli sample; the whole input at 1.0."""
    return df if fraction >= 1.0 else df.sample(withReplacement=False, fraction=fraction, seed=seed)


def featured_from_sources(
    prescribers: DataFrame,
    payments: DataFrame,
    drug: DataFrame,
    recipient: DataFrame,
    sample_fraction: float = 1.0,
) -> DataFrame:
    """Clean, aggregate, join and derive features from four raw source frames."""
    joined = join_data(
        clean_prescribers(prescribers),
        aggregate_payments(clean_payments(payments)),
        aggregate_drug_data(clean_drug_data(drug)),
        aggregate_recipient_data(clean_recipient_data(recipient)),
    )
    return build_features(sample_rows(joined, sample_fraction))


def build_featured_dataset(spark: SparkSession, root: str, sample_fraction: float = 1.0) -> DataFrame:
    """Featured rows from the CSV sources below `root`.

    The prescriber text is parsed once into a columnar table, because the key sketch and the join
    both read it; the other sources are read once and reduced at once.
    """
    return featured_from_sources(
        materialize(load_prescribers(spark, root)),
        load_payments(spark, root),
        load_drug_data(spark, root),
        load_recipient_data(spark, root),
        sample_fraction,
    )


def _snapshot_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return load_featured_data(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def reuse_or_build_features(
    spark: SparkSession, root: str, path: str, sample_fraction: float = 1.0, incremental: bool = False
) -> tuple[DataFrame, int, bool]:
    """The feature snapshot, its row count, and whether it was reused as it was.

    A snapshot is reused only when the raw files name a single year and it was built with the same
    `sample_fraction`; otherwise it is rebuilt and written by year, so that later scans can skip years.
    `incremental` reuses all years whose inputs have not changed and computes only the others.
    """
    if incremental:
        saved, rows, years = refresh_features(spark, root, path, sample_fraction)
        return saved, rows, not years
    manifest = read_manifest(spark, path) or {}
    alike = {entry["settings"] for entry in manifest.values()} <= {f"sample_fraction={sample_fraction}"}
    existing = _snapshot_or_none(spark, path) if alike and not has_multi_year_raw_data(spark, root) else None
    if existing is not None:
        return existing, existing.count(), True
    built, rows = snapshot(build_featured_dataset(spark, root, sample_fraction), path, partition_by=[REPORT_YEAR])
    write_manifest(spark, path, source_manifest(spark, root, settings=f"sample_fraction={sample_fraction}"))
    return built, rows, False
