from pathlib import Path

import pytest
from pyspark.sql import functions as F

from peerlight import sources


def write(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def raw(tmp_path):
    write(tmp_path / "payments_2022.csv", "Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars\n1,2.5\n")
    write(
        tmp_path / "payments_2023.csv",
        'Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars,Note\n2.0,3,"two\nlines ""quoted"""\n3,abc,x\n',
    )
    write(tmp_path / "prescribers_2022.csv", "Prscrbr_NPI,Tot_Clms,Extra\n7,12.0,1.5\n")
    write(tmp_path / "prescribers_2023.csv", "PRSCRBR_NPI,Tot_Clms,Prscrbr_Type_Src\n8,*,S\n")
    write(tmp_path / "prescribers_old.csv", "PRSCRBR_NPI\n9\n")
    write(tmp_path / "prescriber_drug-002.csv", "Prscrbr_NPI,Brnd_Name,Tot_Clms\n7,A,1\n")
    write(tmp_path / "recipient_profile.csv", "Covered_Recipient_NPI\n7\n7\n")
    write(tmp_path / "leie.csv", "NPI,EXCLDATE\n0000000007,20240115\n")
    write(tmp_path / "labels" / "cia.csv", "npi\n7\n")
    return str(tmp_path)


def test_payments_with_quoted_line_breaks_over_two_years(spark, raw):
    rows = sources.load_payments(spark, raw).orderBy("report_year", "Covered_Recipient_NPI").collect()
    assert [(r.Covered_Recipient_NPI, r.Total_Amount_of_Payment_USDollars, r.report_year) for r in rows] == [
        ("1", 2.5, 2022), ("2.0", 3.0, 2023), ("3", None, 2023),
    ]
    assert [r.Note for r in rows] == [None, 'two\nlines "quoted"', "x"]


def test_prescriber_header_variants_meet_in_one_column(spark, raw):
    df = sources.load_prescribers(spark, raw)
    rows = {r.PRSCRBR_NPI: r for r in df.collect()}
    assert set(rows) == {"7", "8"}
    assert "Prscrbr_NPI" not in df.columns and "Prscrbr_Type_src" in df.columns
    assert rows["7"].Tot_Clms == 12 and rows["8"].Tot_Clms is None
    assert dict(df.dtypes)["Extra"] == "double" and rows["8"].Extra is None


def test_extras_stay_text_without_inference(spark, raw):
    assert dict(sources.load_prescribers(spark, raw, infer_extras=False).dtypes)["Extra"] == "string"


def test_undated_files(spark, raw):
    assert [r.report_year for r in sources.load_recipient_data(spark, raw).collect()] == [2023, 2023]
    assert sources.load_drug_data(spark, raw).first().report_year == 2023


def test_dated_drug_files_hide_the_undated_one(spark, raw):
    write(Path(raw) / "prescriber_drug_2021.csv", "Prscrbr_NPI,Brnd_Name,Tot_Clms\n5,B,2\n")
    assert [r.report_year for r in sources.load_drug_data(spark, raw).collect()] == [2021]


def test_a_dataset_may_be_a_folder_of_parts(spark, tmp_path):
    for part in (1, 2):
        write(tmp_path / "prescribers_2020.csv" / f"part-{part}.csv", f"PRSCRBR_NPI,Tot_Clms\n{part},1\n")
    df = sources.load_prescribers(spark, str(tmp_path))
    assert sorted((r.PRSCRBR_NPI, r.report_year) for r in df.collect()) == [("1", 2020), ("2", 2020)]


def test_missing_files_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.load_prescribers(spark, str(tmp_path))
    write(tmp_path / "prescribers_2020.csv", "Name\nx\n")
    with pytest.raises(ValueError, match="PRSCRBR_NPI"):
        sources.load_prescribers(spark, str(tmp_path))
    write(tmp_path / "leie.csv", "Name,EXCLDATE\nx,y\n")
    with pytest.raises(ValueError, match="EXCLNPI"):
        sources.load_leie(spark, str(tmp_path / "leie.csv"))


def test_optional_lists(spark, raw):
    assert sources.load_cia_labels(spark, raw).first().npi == "7"
    assert sources.load_doj_labels(spark, raw) is None


def test_leie_keys_stay_text(spark, raw):
    assert sources.load_leie(spark, f"{raw}/leie.csv").first().NPI == "0000000007"


def test_multi_year_detection(spark, raw, tmp_path_factory):
    assert sources.has_multi_year_raw_data(spark, raw)
    single = tmp_path_factory.mktemp("single")
    write(single / "prescribers_2023.csv", "PRSCRBR_NPI\n1\n")
    assert not sources.has_multi_year_raw_data(spark, str(single))


def test_year_comes_from_the_file_name_only(spark):
    df = spark.createDataFrame([("a_2019/x_2021.csv",), ("a_2019/x.csv",), ("x_1999.csv",)], "f string")
    assert [r.y for r in df.select(sources.year_in_name("f").alias("y")).collect()] == [2021, None, None]


def test_snapshot_counts_rows_and_prunes_years(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4 + 2020).cast("int").alias("report_year"))
    saved, rows = sources.snapshot(df, str(tmp_path / "s"), partition_by=["report_year"])
    assert rows == 100 and saved.filter("report_year = 2021").count() == 25
    plan = saved.filter("report_year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_year" in plan


def test_materialize_uses_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    kept = sources.materialize(spark.range(3))
    assert folder in kept.inputFiles()[0] and kept.count() == 3


def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.range(10).repartition(4)
    sources.write_csv(df, str(tmp_path / "c"), single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 10
    sources.save_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 10
