"""The splittable quoted reader against Spark's own one-task `multiLine` reader."""

import random

import pytest
from pyspark.sql import functions as F

from peerlight.sources import load_payments, load_prescribers, read_csv
from peerlight.sources.loaders import merged_types
from peerlight.sources.quoted import quoted_records, read_quoted_csv

ODD = ['a "quoted" word', "line\nbreak", "\n\n", "comma, comma", "", '"', '""\n"', "plain", "x\r\ny", 'ends with quote"', "é\n🙂", ",\n,", "5\" pipe"]


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def body(rnd, rows, end="\n"):
    lines = ["id,note,amount,more"]
    for i in range(rows):
        cells = [str(i)] + [rnd.choice(ODD) * rnd.choice([1, 1, 1, 7]) for _ in range(3)]
        lines.append(",".join(quoted(c) if rnd.random() < 0.3 or set(c) & set(',"\n\r') else c for c in cells))
    return end.join(lines) + end


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges far shorter than a record may be."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_to(size):
        for k in old:
            spark.conf.set(k, str(size))

    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def both(spark, path):
    options = {"escape": '"'}
    wanted = spark.read.options(header=True, multiLine=True, recursiveFileLookup=True, **options).csv(path)
    return [tuple(r) for r in wanted.collect()], [tuple(r) for r in read_quoted_csv(spark, path, options).collect()]


@pytest.mark.parametrize("size", [64, 300, 5_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_reader_of_one_task(spark, tmp_path, tiny_ranges, size, end):
    rnd = random.Random(size)
    for part in range(2):
        (tmp_path / f"part-{part}.csv").write_text(body(rnd, 120, end), newline="")
    wanted, _ = both(spark, str(tmp_path))
    tiny_ranges(size)
    wanted_again, got = both(spark, str(tmp_path))
    assert sorted(map(str, got)) == sorted(map(str, wanted)) == sorted(map(str, wanted_again))
    assert quoted_records(spark, str(tmp_path)).select(F.input_file_name()).rdd.getNumPartitions() > 2


def test_a_field_over_many_ranges(spark, tmp_path, tiny_ranges):
    long = "\n".join(f"line {i}, with \"\"quotes\"\"" for i in range(400))
    (tmp_path / "a.csv").write_text(f'id,note\n1,"{long}"\n2,b\n3,"{long}"\n4,"x"')
    tiny_ranges(128)
    wanted, got = both(spark, str(tmp_path))
    assert sorted(got) == sorted(wanted) and len(got) == 4


def test_hardly_any_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,note\n")
    (tmp_path / "b.csv").write_text('id,note\n\n1,"a\n\nb"\n\n')
    for name in "ab":
        wanted, got = both(spark, str(tmp_path / f"{name}.csv"))
        assert got == wanted


def test_payments_are_read_by_many_tasks(spark, tmp_path, tiny_ranges):
    rows = "".join(f'{i},{i}.5,"two\nlines ""{i}"""\n' for i in range(500))
    (tmp_path / "payments_2023.csv").write_text("Covered_Recipient_NPI,Total_Amount_of_Payment_USDollars,Note\n" + rows)
    tiny_ranges(1_000)
    df = load_payments(spark, str(tmp_path))
    assert df.count() == 500 and df.agg(F.sum("Total_Amount_of_Payment_USDollars")).first()[0] == sum(i + 0.5 for i in range(500))
    assert df.filter("Note = 'two\nlines \"7\"'").count() == 1
    assert df.select(F.spark_partition_id()).distinct().count() > 4


def test_one_type_over_all_years(spark, tmp_path):
    (tmp_path / "prescribers_2022.csv").write_text("PRSCRBR_NPI,Extra,Part,Flag,Void\n1,5,7,true,\n")
    (tmp_path / "prescribers_2023.csv").write_text("PRSCRBR_NPI,Extra,Part,Flag,Void\n2,*,7.5,FALSE,\n3,,,,\n")
    df = load_prescribers(spark, str(tmp_path))
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in ("Extra", "Part", "Flag", "Void")] == ["string", "double", "boolean", "string"]
    rows = {r.PRSCRBR_NPI: (r.Extra, r.Part, r.Flag) for r in df.collect()}
    assert rows == {"1": ("5", 7.0, True), "2": ("*", 7.5, False), "3": (None, None, None)}


def test_types_merge_in_any_order(spark):
    frames = [spark.createDataFrame([(v,)], "x string") for v in ("5", "1e3", None, " ", "true", "-7", "9999999999999999999")]
    assert merged_types(frames[:1]) == {"x": "bigint"} and merged_types([frames[0], frames[6]]) == {"x": "double"}
    assert merged_types(frames[:4]) == merged_types(frames[3::-1]) == {"x": "double"}
    assert merged_types(frames) == {"x": "string"} and merged_types(frames[2:4]) == {"x": "string"}


def test_single_file_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,\n")
    assert read_csv(spark, str(tmp_path / "a.csv")).dtypes == [("a", "bigint"), ("b", "string")]
