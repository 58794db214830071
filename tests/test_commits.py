"""Tables with a commit log: whole writes, conflicts, repeats, compaction."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.sources import commits
from caseweave.sources.incremental import read_done, record_labels, run_resumable
from caseweave.sources.tables import append, overwrite, read_table

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def rows(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], SCHEMA)


def keys_of(df):
    return sorted(r.k for r in df.collect())


def test_a_write_that_was_not_committed_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append(rows(spark, 1, 2), path)
    with monkeypatch.context() as m:
        m.setattr(commits, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            append(rows(spark, 3), path)
        with pytest.raises(RuntimeError):
            commits.commit_once(rows(spark, 4), path, "batch-1")
    assert len(os.listdir(f"{path}/_data")) == 3  # the files are there
    assert keys_of(read_table(spark, path, SCHEMA)) == [1, 2]
    append(rows(spark, 3), path)
    assert keys_of(read_table(spark, path, SCHEMA)) == [1, 2, 3]


def test_a_name_is_taken_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    os.makedirs(folder)
    assert commits._publish(spark, folder, "7", "first") and not commits._publish(spark, folder, "7", "second")
    assert commits._read_text(spark, f"{folder}/7") == "first"
    assert [f for f in os.listdir(folder) if "draft" in f and not f.endswith(".crc")] == []


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    a, b = (commits.Transaction(spark, path, SCHEMA, "k") for _ in range(2))
    a.append(rows(spark, 1, 2))
    b.append(rows(spark, 3))  # other keys: both are in
    assert keys_of(b.read()) == [1, 2, 3] and keys_of(a.read()) == [1, 2]
    with pytest.raises(commits.CommitConflict):
        a.append(rows(spark, 3, 4))
    assert keys_of(read_done(spark, path, SCHEMA)) == [1, 2, 3]


def test_tokens_are_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.commit_once(rows(spark, 1), path, "q-1", "q") and not commits.commit_once(rows(spark, 9), path, "q-1", "q")
    assert commits.commit_once(rows(spark, 2), path, "q-2", "q")
    commits.compact(spark, path, SCHEMA)
    assert not commits.commit_once(rows(spark, 9), path, "q-2", "q")
    assert keys_of(read_done(spark, path, SCHEMA)) == [1, 2]
    with pytest.raises(ValueError, match="number"):
        commits.commit_once(rows(spark, 1), path, "12")


def test_files_without_a_log_become_the_first_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(rows(spark, 1, 2), path)
    assert keys_of(read_done(spark, path, SCHEMA)) == [1, 2]
    append(rows(spark, 3), path)
    assert keys_of(read_done(spark, path, SCHEMA)) == keys_of(read_table(spark, path, SCHEMA)) == [1, 2, 3]
    overwrite(rows(spark, 5), path)  # takes the log with it
    assert keys_of(read_table(spark, path, SCHEMA)) == [5]


def test_compaction_beside_a_writer(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        append(rows(spark, k), path)
    writer = commits.Transaction(spark, path, SCHEMA, "k")
    commits.compact(spark, path, SCHEMA)
    assert len(commits.live(commits.commits(spark, path))) == 1
    writer.append(rows(spark, 7))
    assert keys_of(read_done(spark, path, SCHEMA)) == [0, 1, 2, 3, 7]
    commits.compact(spark, path, SCHEMA)
    commits.compact(spark, path, SCHEMA)
    assert keys_of(read_done(spark, path, SCHEMA)) == [0, 1, 2, 3, 7]


def test_runs_that_meet_write_no_row_twice(spark, tmp_path):
    path = str(tmp_path / "t")

    def other_run(df):
        if not read_done(spark, path, SCHEMA).count():
            run_resumable(rows(spark, *range(6)), path, "k", lambda x: x, SCHEMA)
        return df

    with pytest.raises(commits.CommitConflict):
        run_resumable(rows(spark, *range(4, 12)), path, "k", other_run, SCHEMA)
    assert keys_of(run_resumable(rows(spark, *range(12)), path, "k", lambda x: x, SCHEMA, 3)) == list(range(12))


def test_recorders_that_meet(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    real = commits.Transaction.append

    def late(self, df):
        monkeypatch.setattr(commits.Transaction, "append", real)
        record_labels(rows(spark, 1), path, "k", {})
        real(self, df)

    monkeypatch.setattr(commits.Transaction, "append", late)
    with pytest.raises(commits.CommitConflict):
        record_labels(rows(spark, 1, 2), path, "k", {})
    assert keys_of(read_done(spark, path, SCHEMA)) == [1]


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_done(spark, path, SCHEMA).count() == 0
    append(rows(spark), path)
    assert read_done(spark, path, SCHEMA).agg(F.count("*")).first()[0] == 0
