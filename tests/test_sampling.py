import hashlib

import pytest
from pyspark.sql import functions as F

from caseweave.operators import sampling
from caseweave.operators.sampling import sample_exact, sample_per_group, sample_prefix


def expected(n_rows, n, seed):
    order = sorted((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i) for i in range(n_rows))
    return [i for _, i in order[:n]]


@pytest.mark.parametrize("n", [0, 1, 50, 999, 1000, 5000])
@pytest.mark.parametrize("partitions", [1, 7])
def test_exact_size_and_same_rows(spark, n, partitions):
    df = spark.range(1000).repartition(partitions)
    got = [r.id for r in sample_exact(df, n, 42, "id").collect()]
    assert got == expected(1000, n, 42)


@pytest.mark.parametrize("slot_rows", [1, 10_000])
@pytest.mark.parametrize("n", [1, 50, 999, 1000, 5000])
def test_large_samples_are_the_same_rows(spark, plan_of, monkeypatch, n, slot_rows):
    """Found by refining the slot of the last row; nothing is limited in one task."""
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 0)
    monkeypatch.setattr(sampling, "SLOT_ROWS", slot_rows)
    df = spark.range(1000).repartition(5)
    chosen = sample_exact(df, n, 42, "id")
    assert [r.id for r in chosen.collect()] == expected(1000, n, 42)
    assert "TakeOrdered" not in plan_of(chosen)


def test_large_samples_of_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ONE_TASK_ROWS", 0)
    df = spark.range(300).select((F.col("id") % 3).alias("id"), F.lit("x").alias("text"))
    for n in (0, 1, 100, 101, 250, 300, 400):
        got = sample_exact(df, n, 7, "id").collect()
        assert len(got) == min(n, 300)
    few = sample_exact(spark.createDataFrame([("a",), (None,), ("b",)], "id string"), 2, 1, "id")
    assert few.count() == 2


def test_prefix_and_seeds(spark):
    df = spark.range(500)
    whole = [r.id for r in sample_exact(df, 100, 7, "id").collect()]
    assert [r.id for r in sample_prefix(df, 30, 100, 7, "id").collect()] == whole[:30]
    assert [r.id for r in sample_prefix(df, 300, 100, 7, "id").collect()] == whole
    assert whole != [r.id for r in sample_exact(df, 100, 8, "id").collect()]


def test_empty_table(spark):
    assert sample_exact(spark.range(0), 5, 1, "id").count() == 0


def test_payload_is_cut_at_the_scan(spark, plan_of, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("text", F.lit("x")).write.parquet(path)
    plan = plan_of(sample_exact(spark.read.parquet(path), 10, 1, "id"))
    assert "TakeOrderedAndProject" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_per_group(spark, plan_of):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") % 3 == 0, "big").otherwise(
        F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))))
    got = sample_per_group(df, 4, 42, "g", "id")
    by_group = {}
    for r in got.collect():
        by_group.setdefault(r.g, set()).add(r.id)
    assert {len(v) for v in by_group.values()} == {4} and len(by_group) == 6
    ids = [i for i in range(1000) if i % 3 == 0]
    first = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in ids)[:4]
    assert by_group["big"] == {i for _, i in first}
    assert "WindowGroupLimit" in plan_of(got)
