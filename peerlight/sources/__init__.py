from peerlight.sources.loaders import (
    add_report_year,
    column_kinds,
    has_multiple_years,
    has_multi_year_raw_data,
    list_datasets,
    load_cia_labels,
    load_doj_labels,
    load_drug_data,
    load_featured_data,
    load_leie,
    load_optional_csv,
    load_payments,
    load_prescribers,
    load_recipient_data,
    load_yearly_csvs,
    normalize_prescriber_schema,
    read_csv,
    read_raw_csv,
    types_of_kinds,
    union_years,
    year_in_name,
)
from peerlight.sources.quoted import read_quoted_csv
from peerlight.sources.schema import validate_any_column, validate_columns
from peerlight.sources.snapshots import (
    keep_methods_compilable,
    materialize,
    materialize_counted,
    owned_snapshots,
    persisted,
    remove_folder,
    save_json,
    save_model,
    shared_folder,
    snapshot,
    write_csv,
    write_parquet,
)

__all__ = [
    "keep_methods_compilable",
    "add_report_year",
    "column_kinds",
    "has_multi_year_raw_data",
    "has_multiple_years",
    "list_datasets",
    "load_cia_labels",
    "load_doj_labels",
    "load_drug_data",
    "load_featured_data",
    "load_leie",
    "load_optional_csv",
    "load_payments",
    "load_prescribers",
    "load_recipient_data",
    "load_yearly_csvs",
    "materialize",
    "materialize_counted",
    "normalize_prescriber_schema",
    "owned_snapshots",
    "persisted",
    "remove_folder",
    "read_csv",
    "read_quoted_csv",
    "read_raw_csv",
    "save_json",
    "save_model",
    "shared_folder",
    "snapshot",
    "types_of_kinds",
    "union_years",
    "validate_any_column",
    "validate_columns",
    "write_csv",
    "write_parquet",
    "year_in_name",
]
