import datetime

import pytest

from peerlight.operators import labels

D = datetime.date


def keyed(spark, rows):
    return spark.createDataFrame(rows, "provider_id string, report_year int")


def test_year_edges(spark):
    dates = ["20231231", "1/1/2024", "2025-12-31", "2026-01-01", "20241399", None]
    leie = spark.createDataFrame([(f"{i:010d}", d) for i, d in enumerate(dates, 1)], "provider_id string, EXCLDATE string")
    df = keyed(spark, [(f"{i:010d}", 2023) for i in range(1, 8)])
    rows = labels.add_temporal_fraud_label(df, leie, horizon_years=2).orderBy("provider_id").collect()
    assert [(r.excluded_on_or_before_report_year, r.is_future_fraud, r.is_fraud) for r in rows] == [
        (1, 0, 0), (0, 1, 1), (0, 1, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0),
    ]


def test_the_row_year_decides_and_the_argument_is_the_fallback(spark):
    leie = spark.createDataFrame([("0000000001", "2024-06-01")], "provider_id string, EXCLDATE string")
    by_row = labels.add_temporal_fraud_label(keyed(spark, [("0000000001", y) for y in (2021, 2022, 2024)]), leie)
    assert [r.is_fraud for r in by_row.orderBy("report_year").collect()] == [0, 1, 0]
    without = spark.createDataFrame([("0000000001",)], "provider_id string")
    assert labels.add_temporal_fraud_label(without, leie, report_year=2023).first().is_fraud == 1
    assert labels.add_temporal_fraud_label(without, leie, report_year=2021).first().is_fraud == 0


def test_the_earliest_readable_exclusion_wins_and_empty_keys_are_dropped(spark):
    leie = spark.createDataFrame(
        [("0000000001", "2024-06-01"), ("0000000001", "20230101"), ("0000000001", "bad"), ("0000000000", "20230101")],
        "provider_id string, EXCLDATE string",
    )
    rows = labels.prepare_leie_exclusions(leie).collect()
    assert [(r.provider_id, r.exclusion_date) for r in rows] == [("0000000001", D(2023, 1, 1))]


@pytest.mark.parametrize("alias", labels.ID_ALIASES)
def test_list_aliases_and_padding(spark, alias):
    listed = spark.createDataFrame([("5",), ("5",), ("",), (None,)], f"{alias} string")
    rows = labels.prepare_optional_label_source(listed, "cia_flag").collect()
    assert [r.provider_id for r in rows] == ["0000000005"]


def test_list_without_key_is_an_error(spark):
    with pytest.raises(ValueError, match="cia_flag"):
        labels.prepare_optional_label_source(spark.createDataFrame([("5",)], "name string"), "cia_flag")


def test_binary_flag(spark):
    df = keyed(spark, [("0000000005", 2023), ("0000000006", 2023), (None, 2023)])
    assert {r.cia_flag for r in labels.add_binary_optional_flag(df, None, "cia_flag").collect()} == {0}
    listed = spark.createDataFrame([("5",), ("5",)], "NPI string")
    rows = labels.add_binary_optional_flag(df, listed, "cia_flag").collect()
    assert {r.provider_id: r.cia_flag for r in rows} == {"0000000005": 1, "0000000006": 0, None: 0}
    assert len(rows) == 3


def test_dated_and_undated_optional_flags(spark):
    df = keyed(spark, [("0000000005", 2022), ("0000000005", 2023), ("0000000006", 2023)])
    listed = spark.createDataFrame([("5", "2023-03-01"), ("6", None)], "NPI string, day string")
    dated = labels.prepare_optional_label_source(listed, "doj_flag", "day")
    rows = labels.add_optional_flag(df, dated, "doj_flag", horizon_years=1).orderBy("provider_id", "report_year")
    assert [r.doj_flag for r in rows.collect()] == [1, 0, 0]
    undated = labels.prepare_optional_label_source(listed, "doj_flag")
    assert {r.doj_flag for r in labels.add_optional_flag(df, undated, "doj_flag").collect()} == {1}


def test_static_label(spark):
    df = keyed(spark, [("0000000005", 2022), ("0000000006", 2023)])
    leie = spark.createDataFrame([("0000000005", "x"), ("0000000005", "y")], "provider_id string, EXCLDATE string")
    assert [r.is_fraud for r in labels.add_fraud_label(df, leie).orderBy("provider_id").collect()] == [1, 0]


def test_multi_signal_labels(spark):
    df = spark.createDataFrame(
        [("0000000001", 2023, "T", "S", 5.0, 1.0, 1, 0), ("0000000002", 2023, "T", "S", None, 0.0, 0, 0)],
        "provider_id string, report_year int, Prscrbr_Type string, Prscrbr_State_Abrvtn string, "
        "Opioid_Prscrbr_Rate double, payment_per_claim double, high_payment_flag int, high_cost_flag int",
    )
    leie = spark.createDataFrame([("0000000001", "20240601")], "provider_id string, EXCLDATE string")
    doj = spark.createDataFrame([("1",)], "NPI string")
    rows = labels.add_multi_signal_labels(df, leie, doj_df=doj).orderBy("provider_id").collect()
    first, second = rows
    assert (first.cia_flag, first.doj_flag, first.enforcement_risk_flag) == (0, 1, 1)
    assert (first.multi_signal_label_strength, first.is_fraud, first.opioid_peer_percentile) == (3, 1, 1.0)
    assert (second.multi_signal_label_strength, second.is_fraud, second.Opioid_Prscrbr_Rate) == (0, 0, 0.0)
