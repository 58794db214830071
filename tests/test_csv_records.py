"""CSV files cut into many splits against whole-file reading."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from caseweave.sources.csv_records import CSV, read_csv

NAMES = ["a", "b c", "text"]
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in NAMES])
SPLITS = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SPLITS}
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng):
    parts = ["x", "word ", '"', ",", "\n", "é🙂", "", " ", "\n\n", "'", "\\", "\t"]
    return "".join(rng.choices(parts, k=rng.choice([0, 1, 3, 30])))


def write(folder, number, rows, end="\n", blank=False):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(NAMES)
    for row in rows:
        writer.writerow(row)
        if blank:
            out.write(end)
    (folder / f"{number}.csv").write_bytes(out.getvalue().encode())


def whole(spark, path):
    return spark.read.schema(SCHEMA).options(**CSV).option("multiLine", True).csv(path)


@pytest.mark.parametrize(("end", "blank"), [("\n", False), ("\r\n", False), ("\n", True)])
def test_same_rows_as_whole_files(spark, tmp_path, small_splits, end, blank):
    rng = random.Random(11)
    rows = [[f"id{i}", field(rng), field(rng)] for i in range(600)]
    rows[300][2] = "one very long message\n" * 200  # longer than several splits
    for number, part in enumerate((rows[:450], rows[450:451], rows[451:], [])):
        write(tmp_path, number, part, end, blank)
    found = read_csv(spark, str(tmp_path), SCHEMA, check_header=True)
    expected = whole(spark, str(tmp_path))
    assert found.schema == expected.schema
    key = lambda r: tuple(map(str, r))
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)
    assert found.count() == 600 and found.rdd.getNumPartitions() > 20


def test_header_over_several_splits(spark, tmp_path, small_splits):
    name = "long " * 300 + "\nname"
    (tmp_path / "a.csv").write_text(f'\n"{name}",b\n1,2\n"3\n",4\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (name.replace("\n", " "), "b")])
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), schema).collect())) == [("1", "2"), ("3\n", "4")]


def test_broken_files_are_errors(spark, tmp_path, small_splits):
    for number, (body, message) in enumerate(
        [('1,"2\n', "odd number of quotes"), ('1,a "quoted" word,3\n4,5,6\n', "inside an unquoted field")]
    ):
        path = tmp_path / f"{number}.csv"
        path.write_text("a,b,c\n" + body)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
        with pytest.raises(Exception, match=message):
            read_csv(spark, str(path), schema).collect()


def test_long_fields_are_checked_without_recursion(spark, tmp_path):
    text = 'say ""hello"" now ' * 20_000
    (tmp_path / "a.csv").write_text(f'a,b,c\n1,"{text}",\n')
    row = read_csv(spark, str(tmp_path), T.StructType([T.StructField(n, T.StringType()) for n in "abc"])).first()
    assert row.b == text.replace('""', '"') and row.c is None


def test_typed_columns_and_no_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,x\n,\n3,\"y\ny\"\n")
    (tmp_path / "b.csv").write_text("n,t\n")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    assert sorted(map(tuple, read_csv(spark, str(tmp_path), schema).collect()), key=str) == [(1, "x"), (3, "y\ny"), (None, None)]
