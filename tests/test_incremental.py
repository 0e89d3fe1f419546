"""Snapshots brought up to date by year equal a full build."""

import os
from pathlib import Path

import pytest

from peerlight.plans.featured import build_featured_dataset, reuse_or_build_features
from peerlight.plans.incremental import refresh_features


def write(root, name, text):
    (Path(root) / name).write_text(text)


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    for year in (2021, 2022, 2023):
        write(root, f"prescribers_{year}.csv", f"PRSCRBR_NPI,Prscrbr_Type,Prscrbr_State_Abrvtn,Tot_Clms,Tot_Benes,Tot_Drug_Cst,Extra\n1,a,x,10,5,{year}.5,{year}\n2,b,y,20,8,7.0,3\n")
        write(root, f"payments_{year}.csv", f'Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars,Note\n1,{year},"two\nlines"\n')
        write(root, f"prescriber_drug_{year}.csv", "Prscrbr_NPI,Brnd_Name,Tot_Clms\n1,A,3\n2,B,4\n")
    write(root, "recipient_profile.csv", "Covered_Recipient_NPI\n2\n")
    return str(root)


def same(spark, got, root):
    wanted = build_featured_dataset(spark, root)
    assert dict(got.dtypes) == dict(wanted.dtypes)
    got = got.select(*wanted.columns)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_changed_years_are_written(spark, raw, tmp_path):
    path = str(tmp_path / "features")
    _, rows, years = refresh_features(spark, raw, path)
    assert rows == 6 and years == [2021, 2022, 2023]
    first = files(path)
    assert refresh_features(spark, raw, path)[2] == [] and files(path) == first

    write(raw, "payments_2022.csv", "Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars,Note\n1,77.25,x\n2,5,y\n")
    got, rows, years = refresh_features(spark, raw, path)
    assert years == [2022] and rows == 6
    second = files(path)
    assert {f for f in first if "report_year=2022" not in f} == {f for f in second if "report_year=2022" not in f}
    assert not {f for f in first if "report_year=2022" in f} & set(second)
    same(spark, got, raw)
    assert reuse_or_build_features(spark, raw, path, incremental=True)[2] is True


def test_undated_files_belong_to_the_default_year(spark, raw, tmp_path):
    path = str(tmp_path / "features")
    refresh_features(spark, raw, path)
    write(raw, "recipient_profile.csv", "Covered_Recipient_NPI\n1\n1\n2\n")
    got, _, years = refresh_features(spark, raw, path)
    assert years == [2023]
    same(spark, got, raw)


def test_a_new_type_rebuilds_all_years(spark, raw, tmp_path):
    path = str(tmp_path / "features")
    got, _, _ = refresh_features(spark, raw, path)
    assert dict(got.dtypes)["Extra"] == "bigint"
    write(raw, "prescribers_2021.csv", "PRSCRBR_NPI,Prscrbr_Type,Prscrbr_State_Abrvtn,Tot_Clms,Tot_Benes,Tot_Drug_Cst,Extra\n1,a,x,1,1,1,2.5\n")
    got, rows, years = refresh_features(spark, raw, path)
    assert years == [2021, 2022, 2023] and rows == 5 and dict(got.dtypes)["Extra"] == "double"
    same(spark, got, raw)


def test_new_and_lost_years(spark, raw, tmp_path):
    path = str(tmp_path / "features")
    refresh_features(spark, raw, path)
    write(raw, "prescribers_2024.csv", "PRSCRBR_NPI,Prscrbr_Type,Prscrbr_State_Abrvtn,Tot_Clms,Tot_Benes,Tot_Drug_Cst,Extra\n9,a,x,1,1,1,4\n")
    got, rows, years = refresh_features(spark, raw, path)
    assert years == [2024] and rows == 7
    same(spark, got, raw)
    os.rename(f"{raw}/prescribers_2024.csv", f"{raw}/other_2024.csv")
    got, rows, _ = refresh_features(spark, raw, path)
    assert rows == 6
    same(spark, got, raw)


def test_a_sampled_snapshot_is_not_taken_for_a_full_one(spark, raw, tmp_path):
    path = str(tmp_path / "features")
    _, rows, years = refresh_features(spark, raw, path, sample_fraction=0.0001)
    assert rows < 6 and years
    got, rows, years = refresh_features(spark, raw, path)
    assert rows == 6 and years == [2021, 2022, 2023]
    same(spark, got, raw)
