import pytest
from pyspark.sql import functions as F
from pyspark.sql import Row

from caseweave import schemas
from caseweave.operators.filters import drop_short
from caseweave.operators.lookup import hot_keys, key_filter, lookup_join, only_wanted
from caseweave.operators.pairs import (
    add_clean, filter_brand_replies, keep_first, reconstruct_pairs, reply_outcomes,
    stage_counts,
)
from caseweave.plans.prepare import clean_pairs, prepare_pairs
from caseweave.sources.tables import (
    append, load_vectors, overwrite, read_table, read_tweets_csv, save_vectors,
)

CSV = '''tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id
1,u1,True,t1,"my phone, it ""froze""
again today",2,
2,Brand,False,t2,@u1 please restart it,,1
3,Brand,false,t3,a reply to nothing,,
4,Brand,False,t4,a reply to the unknown,,99
5,Brand,False,t5,a reply to ourselves,,2
6,u2,TRUE,t6,battery drains so fast,7,
7,Brand,False,t7,check your settings,,6.0
8,u3,,t8,empty flag is not inbound,9,
9,Brand,False,t9,answer to the empty flag,,8
10,Other,False,t10,other brand,,6
20,u4,True,t01,first of two rows is inbound,21,
20,Brand,False,t02,second is not,,
21,Brand,False,t21,answers the first,,20
30,Brand,False,t01,first of two rows is not inbound,,
30,u5,True,t02,second is inbound,31,
31,Brand,False,t31,must be dropped,,30
'''


def write_csv(tmp_path, text=CSV, name="raw.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_scan(spark, tmp_path):
    rows = {r.tweet_id: r for r in read_tweets_csv(spark, write_csv(tmp_path)).collect()}
    assert rows[1].text == 'my phone, it "froze"\nagain today'
    assert rows[1].inbound is True and rows[2].inbound is False and rows[3].inbound is False
    assert rows[6].inbound is True and rows[8].inbound is False
    assert rows[7].in_response_to_tweet_id == 6 and rows[3].in_response_to_tweet_id is None


def test_csv_columns_by_name(spark, tmp_path):
    header = "extra,text,inbound,tweet_id,author_id,created_at,response_tweet_id," \
             "in_response_to_tweet_id\n"
    path = write_csv(tmp_path, header + "x,null,True,5,u,t,,4\n")
    row = read_tweets_csv(spark, path).first()
    assert (row.tweet_id, row.text, row.in_response_to_tweet_id) == (5, "null", 4)


def test_csv_files_of_another_layout_fail(spark, tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    names = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"]
    row = dict(zip(names, ["1", "u", "True", "t", "hello", "", "4"]))
    for number, order in enumerate([names, names[::-1]]):
        (folder / f"{number}.csv").write_text(f"{','.join(order)}\n{','.join(row[n] for n in order)}\n")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="(?i)header"):
            read_tweets_csv(spark, str(folder), multi_line).collect()
    with pytest.raises(ValueError, match="lacks"):
        read_tweets_csv(spark, write_csv(tmp_path, "tweet_id,text\n1,x\n"))


def test_pair_branches(spark, tmp_path):
    tweets = read_tweets_csv(spark, write_csv(tmp_path))
    replies = filter_brand_replies(tweets, "Brand")
    for hot in (1, 1_000_000):  # all keys frequent, none frequent
        pairs = reconstruct_pairs(tweets, replies, hot_key_rows=hot).collect()
        assert {(p.thread_id, p.customer_tweet_id, p.brand_tweet_id) for p in pairs} == {
            (1, 1, 2), (6, 6, 7), (20, 20, 21),
        }
        by_id = {p.brand_tweet_id: p for p in pairs}
        assert by_id[21].customer_msg == "first of two rows is inbound"
        assert by_id[7].timestamp == "t7" and by_id[7].brand_reply == "check your settings"
        status = {
            r.brand_tweet_id: r.status
            for r in reply_outcomes(tweets, replies, hot_key_rows=hot).collect()
        }
        assert status[3] == "no_pointer" and status[4] == "parent_absent"
        assert status[5] == status[9] == status[31] == "parent_not_inbound"
        assert status[2] == status[7] == status[21] == "pair"


def test_stage_counts(spark, tmp_path):
    tweets = read_tweets_csv(spark, write_csv(tmp_path))
    counts = {r.stage: r.n_rows for r in stage_counts(tweets, "Brand").collect()}
    assert counts["replies"] == filter_brand_replies(tweets, "Brand").count()
    assert counts["replies"] == sum(
        counts[s] for s in ("no_pointer", "parent_absent", "parent_not_inbound", "pairs")
    )
    assert counts["pairs"] == counts["long_enough"] == counts["sampled"] == 3


def tweets_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.TWEETS)


def test_one_parent_with_a_third_of_all_replies(spark, plan_of):
    customers = [(i, "u", True, "t", f"message {i}", None, None) for i in range(100)]
    replies = [
        (1000 + i, "B", False, "t", f"reply {i}", None, 7 if i % 3 == 0 else i % 100)
        for i in range(900)
    ]
    copies = [(7, "u", True, "z", "a later copy", None, None)] * 50
    tweets = tweets_frame(spark, customers + copies + replies)
    brand = filter_brand_replies(tweets, "B")
    assert [tuple(r) for r in hot_keys(brand, F.col("in_response_to_tweet_id"), min_rows=50).collect()] == [(7, 7)]
    split = reconstruct_pairs(tweets, brand, hot_key_rows=50)
    plain = reconstruct_pairs(tweets, brand)
    assert split.count() == 900
    assert split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0
    assert {r.customer_msg for r in split.where("thread_id = 7").collect()} == {"message 7"}
    # copies are dropped before the shuffle
    plan = plan_of(split)
    assert "WindowGroupLimit" in plan and "Partial" in plan and "CartesianProduct" not in plan


def test_more_hot_keys_than_any_list_of_fixed_size(spark):
    facts = spark.range(20_000).select("id", (F.col("id") % 2000).alias("k"))
    dims = spark.range(2500).select(F.col("id").alias("d"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    assert hot_keys(facts, F.col("k"), min_rows=10).count() == 2000
    joined = lookup_join(facts, dims, "k", "d", "id", hot_key_rows=10)
    assert joined.count() == 20_000 and joined.where("text <> concat('t', k)").count() == 0


def test_rows_that_nobody_points_at_are_dropped_at_the_scan(spark, plan_of):
    """What is shuffled follows the replies, not the table of parents."""
    replies = spark.range(300).select("id", (F.col("id") * 97).alias("k"))
    wanted, n_bits, n = key_filter(replies, "k")
    parents = spark.range(30_000).select(F.col("id").alias("d"), F.repeat(F.lit("x"), 100).alias("text"))
    left = only_wanted(parents, "d", wanted, n_bits)
    assert n == 300 and 300 <= left.count() < 400
    assert left.join(replies, left["d"] == replies["k"]).count() == 300
    assert "Exchange hashpartitioning" not in plan_of(left)
    for how, rows in (("inner", 300), ("left", 310)):
        facts = replies.unionByName(spark.range(10).select(F.col("id") + 1000, F.lit(None).cast("long").alias("k")).toDF("id", "k"))
        assert lookup_join(facts, parents, "k", "d", "id", how).count() == rows
    none = spark.range(0).select("id", F.col("id").alias("k"))
    assert lookup_join(none, parents, "k", "d", "id").count() == 0


def test_left_lookup_spreads_missing_keys(spark):
    facts = spark.range(1000).select("id", F.expr("if(id % 2 = 0, id, null)").alias("k"))
    dims = spark.range(100).select(F.col("id").alias("d"), F.lit("x").alias("v"))
    joined = lookup_join(facts, dims, "k", "d", "id", how="left", hot_key_rows=1)
    assert joined.count() == 1000 and joined.where("v is not null").count() == 50


def test_keep_first_and_filter(spark, plan_of):
    pairs = spark.createDataFrame(
        [
            Row(brand_tweet_id=3, customer_msg="same  text", brand_reply="c"),
            Row(brand_tweet_id=1, customer_msg="same text", brand_reply="a"),
            Row(brand_tweet_id=2, customer_msg="@x tiny", brand_reply="b"),
        ]
    )
    kept = keep_first(
        drop_short(add_clean(pairs, "customer_msg", "brand_reply")), ["customer_msg_clean"], [F.col("brand_tweet_id")]
    )
    assert [(r.brand_tweet_id, r.brand_reply_clean) for r in kept.collect()] == [(1, "a")]
    # the cleaned text is not copied into the filter
    filters = [x for x in plan_of(kept).splitlines() if "Filter" in x or "Generate" in x]
    assert any("Generate" in x for x in filters) and all("regexp_replace" not in x for x in filters)


def test_later_filters_reach_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "pairs")
    spark.createDataFrame([(i, f"@x message {i}") for i in range(9)], "message_id long, customer_msg string").write.parquet(path)
    kept = drop_short(add_clean(spark.read.parquet(path), "customer_msg")).where("message_id = 3")
    assert "EqualTo(message_id,3)" in plan_of(kept)
    assert [r.customer_msg_clean for r in kept.collect()] == ["message 3"]


def test_prepare_end_to_end(spark, tmp_path):
    tweets = read_tweets_csv(spark, write_csv(tmp_path))
    assert clean_pairs(tweets, "Brand").count() == 3
    sample = prepare_pairs(tweets, "Brand", sample_size=2)
    assert sample.count() == 2
    assert sample.schema.names == schemas.PAIRS.names


def test_sinks_round_trip(spark, tmp_path):
    rows = [(1, "a, \"b\"\nc", None), (2, "", "x")]
    df = spark.createDataFrame(rows, "message_id long, customer_msg_clean string, label string")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        overwrite(df, path, fmt)
        overwrite(df, path, fmt)
        append(df.where("message_id = 1"), path, fmt)
        back = read_table(spark, path, df.schema, fmt)
        got = sorted((r.message_id, r.customer_msg_clean or "") for r in back.collect())
        assert got == [(1, "a, \"b\"\nc"), (1, "a, \"b\"\nc"), (2, "")]


def test_vectors_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 1.0], 3)], schemas.VECTORS)
    path = str(tmp_path / "vectors")
    save_vectors(df, path)
    assert load_vectors(spark, path).collect() == df.collect()
