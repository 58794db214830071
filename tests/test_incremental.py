import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave import schemas
from caseweave.operators.embedding import embed_with
from caseweave.operators.labelling import DECISION_CHECK, INTENT_CHECK
from caseweave.operators.providers import rule_provider
from caseweave.operators.retrieval import broadcast_index
from caseweave.plans.handle import handle_messages
from caseweave.session import shared_folder, store_stage
from caseweave.sources.incremental import (
    pending, read_done, record_labels, run_resumable,
)
from caseweave.sources.tables import save_vectors
from caseweave.streaming.messages import decide_stream, decided

SCHEMA = "message_id long, message string"


def messages(spark, ids):
    return spark.createDataFrame([(i, f"battery message {i}") for i in ids], SCHEMA)


def test_pending(spark):
    todo = pending(messages(spark, range(10)), messages(spark, range(4)), "message_id")
    assert sorted(r.message_id for r in todo.collect()) == list(range(4, 10))


def test_resumable(spark, tmp_path):
    path, schema = str(tmp_path / "out"), messages(spark, [1]).schema

    def process(df):
        return df

    assert read_done(spark, path, schema).count() == 0
    run_resumable(messages(spark, range(5)), path, "message_id", process, schema)
    for _ in range(2):  # the second run has nothing to do
        done = run_resumable(messages(spark, range(20)), path, "message_id", process, schema, 3)
        assert sorted(r.message_id for r in done.collect()) == list(range(20))


def test_record_labels(spark, tmp_path):
    schema = "message_id long, true_intent string, escalate_or_auto string"
    checks, path = {**INTENT_CHECK, **DECISION_CHECK}, str(tmp_path / "labels")

    def record(*rows):
        labels = spark.createDataFrame(rows, schema)
        rejected = record_labels(labels, path, "message_id", checks)
        done = read_done(spark, path, labels.schema)
        return (
            {r.message_id for r in rejected.collect()},
            sorted((r.message_id, r.escalate_or_auto) for r in done.collect()),
        )

    good = (1, "billing_refund", "escalate")
    assert record(good, (2, "billing", "auto")) == ({2}, [(1, "escalate")])
    again = (1, "how_to_question", "auto")
    assert record(again, (2, "how_to_question", "auto")) == (set(), [(1, "escalate"), (2, "auto")])
    # of a repeated key the first in the order of all columns; no key, no label
    rows = [(3, "how_to_question", "escalate"), (3, "how_to_question", "auto"), (None, *again[1:])]
    for _ in range(2):
        assert record(*rows) == ({3, None}, [(1, "escalate"), (2, "auto"), (3, "auto")])


def test_resumable_embedding(spark, tmp_path):
    """Half of the vectors exist; only the other half is sent to the model."""

    def load():
        def model(texts):
            assert all(int(t.split()[-1]) >= 5 for t in texts)
            return [[float(t.split()[-1])] for t in texts]

        return model

    path = str(tmp_path / "vectors")
    schema = T.StructType(
        [T.StructField("message_id", T.LongType()), T.StructField("embedding", schemas.VECTOR)]
    )
    save_vectors(spark.createDataFrame([(i, [0.5]) for i in range(5)], schema), path)
    done = run_resumable(
        messages(spark, range(10)), path, "message_id",
        lambda df: embed_with(df, "message", load), schema,
    )
    got = {r.message_id: r.embedding for r in done.collect()}
    assert got == {i: [0.5] if i < 5 else [float(i)] for i in range(10)}


def test_resumable_after_failure(spark, tmp_path):
    path, schema = str(tmp_path / "out"), messages(spark, [1]).schema
    calls = []

    def fails_on_second_part(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("interrupted")
        return df

    with pytest.raises(RuntimeError):
        run_resumable(
            messages(spark, range(30)), path, "message_id", fails_on_second_part, schema, 3
        )
    assert 0 < read_done(spark, path, schema).count() < 30
    done = run_resumable(messages(spark, range(30)), path, "message_id", lambda d: d, schema, 3)
    assert sorted(r.message_id for r in done.collect()) == list(range(30))


def test_shared_folder_and_stage(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = store_stage(messages(spark, range(3)), "stage")
    assert stored.count() == 3 and shared_folder(spark) in stored.inputFiles()[0]


@pytest.fixture
def world(spark):
    cases = spark.createDataFrame(
        [(i, f"case {i}", f"reply {i}", [float(i), 1.0]) for i in range(1, 20)],
        "message_id long, customer_msg_clean string, brand_reply_clean string,"
        "embedding array<float>",
    )
    index = broadcast_index(
        cases, "message_id",
        payload={"past_customer_msg": "customer_msg_clean",
                 "past_brand_reply": "brand_reply_clean"},
    )

    def handle(batch):
        vectors = F.array(F.col("message_id").cast("float"), F.lit(1.0).cast("float"))
        return handle_messages(
            batch.withColumn("embedding", vectors), index, rule_provider("message")
        )

    return handle


def stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    )


def run(spark, handle, folder, checkpoint="checkpoint"):
    query = decide_stream(
        stream(spark, folder), handle, f"{folder}/sink", f"{folder}/{checkpoint}"
    )
    query.awaitTermination()
    return decided(spark, f"{folder}/sink")


def test_stream_equals_batch_and_resumes(spark, tmp_path, world):
    folder = str(tmp_path)
    messages(spark, range(1, 6)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    messages(spark, range(4, 9)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    first = run(spark, world, folder)
    assert sorted(r.message_id for r in first.collect()) == list(range(1, 9))
    # nothing new
    assert run(spark, world, folder).count() == 8
    # new messages, old ones repeated
    messages(spark, range(7, 13)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    again = run(spark, world, folder)
    batch = world(messages(spark, range(1, 13)))
    assert again.count() == 12 and again.exceptAll(batch).count() == 0
    assert again.schema.names == schemas.MESSAGE_RESULT.names
    # without its checkpoint the stream sees everything again and decides nothing twice
    assert run(spark, world, folder, "another").exceptAll(batch).count() == 0
    assert decided(spark, f"{folder}/sink").count() == 12


def test_repeated_batch_replaces_its_rows(spark, tmp_path, world):
    """A crash after the write and before the commit repeats the micro-batch."""
    import os
    import shutil

    folder = str(tmp_path)
    messages(spark, range(1, 6)).coalesce(1).write.parquet(f"{folder}/in")
    run(spark, world, folder)
    commits = f"{folder}/checkpoint/commits"
    assert os.path.exists(f"{commits}/0")
    copy = str(tmp_path / "crashed")
    shutil.copytree(f"{folder}/checkpoint", copy, ignore=shutil.ignore_patterns("commits"))
    got = run(spark, world, folder, "crashed")
    assert sorted(r.message_id for r in got.collect()) == list(range(1, 6))


def test_messages_without_id_are_all_decided(spark, tmp_path, world):
    folder = str(tmp_path)
    for part in ([(None, "a"), (None, "a"), (1, "z")], [(None, "a"), (1, "b"), (2, "y"), (2, "x")]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        found = run(spark, world, folder)
    rows = sorted((r.message_id or 0, r.message) for r in found.collect())
    assert rows == [(0, "a"), (0, "a"), (0, "a"), (1, "z"), (2, "x")]
    # without its checkpoint nothing with an id is decided twice
    again = run(spark, world, folder, "another")
    assert again.where("message_id is not null").count() == 2


def test_state_is_keys_only(spark, tmp_path, world):
    """The bytes of state do not depend on the texts, and a seen key adds nothing."""
    sizes = {}
    for name, text in (("short", "a"), ("long", "word " * 5000)):
        folder = tmp_path / name
        for _ in range(2):
            rows = [(i, text) for i in range(200)] + [(None, text)] * 5
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = decide_stream(stream(spark, folder), world, f"{folder}/sink", f"{folder}/checkpoint")
        query.awaitTermination()
        states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
        assert {s.numRowsTotal for s in states} == {200}
        files = [f for f in (folder / "checkpoint" / "state").rglob("*.delta")]
        sizes[name] = sum(f.stat().st_size for f in files)
    assert sizes["long"] < 1.05 * sizes["short"]


@pytest.mark.parametrize("step", ["before the write", "before the commit", "after the commit"])
def test_crash_at_each_step(spark, tmp_path, world, monkeypatch, step):
    from caseweave.sources import commits
    from caseweave.streaming import messages as module

    folder = str(tmp_path)
    for ids in (range(1, 6), range(4, 9)):
        messages(spark, ids).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    calls = []

    def crash(real):
        def run_once(*args, **kwargs):
            if len(calls) == 0 and step == "before the write" or len(calls) == 0 and step == "before the commit":
                calls.append(1)
                raise RuntimeError("crash")
            out = real(*args, **kwargs)
            if len(calls) == 0:
                calls.append(1)
                raise RuntimeError("crash")
            return out

        return run_once

    with monkeypatch.context() as m:
        if step == "before the commit":
            m.setattr(commits, "_commit", crash(commits._commit))
        else:
            m.setattr(module, "commit_once", crash(module.commit_once))
        with pytest.raises(Exception, match="crash"):
            run(spark, world, folder)
    found = run(spark, world, folder)
    assert sorted(r.message_id for r in found.collect()) == list(range(1, 9))


def test_keys_are_forgotten_after_a_time(spark, tmp_path, world):
    folder = str(tmp_path)
    schema = f"{SCHEMA}, at timestamp"
    day = lambda d: __import__("datetime").datetime(2024, 1, d)
    query = None
    for d in (1, 2, 20, 25):
        spark.createDataFrame([(1, "again", day(d))], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        incoming = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        query = decide_stream(
            incoming, lambda b: world(b.drop("at")), f"{folder}/sink", f"{folder}/checkpoint", keep_for=("at", "3 days")
        )
        query.awaitTermination()
    assert 1 < decided(spark, f"{folder}/sink").count() < 4
