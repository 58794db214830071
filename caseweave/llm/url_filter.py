"""URL rules by a sort-merge sweep over reversed-host keys.

``www.example.com`` becomes ``com|example|www|``: a rule's host is a prefix of the keys of its host and
of all subdomains, so the rule covers one interval of the key order. URLs are dealt out by ranges of their
keys (with path and a salt, so one hot host or URL is split over many tasks); a rule goes to every range
that its interval touches. Each range is sorted and swept once: a rule is pushed on a stack when its
interval opens and popped when the order leaves it, so the stack holds exactly the nested rules in force,
and the longest of them whose path fits decides.

Defined cases: a null URL, or one without ``://``, has empty host and path; a rule with a null host or
path counts it as empty; of rules with equal host and path, ``block`` wins; of fitting rules the longest in
characters wins, then the longer host; without a fitting rule the verdict is ``default``; repeated rows and
null page ids are judged one by one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys sampled per range to place the range bounds.
SAMPLE_PER_RANGE = 50
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\x01"


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host):
    """Labels from the last to the first, each with an end mark."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _END), F.lit(_END))


def _sweep(default: str):
    def judge(stack: list, host: str, path: str) -> tuple[str | None, str]:
        best = None
        for rule_host, by_size in stack:
            if host != rule_host and not host.endswith("." + rule_host):
                continue
            for size, paths in by_size.items():
                verdict = paths.get(path[:size]) if len(path) >= size else None
                if verdict is not None:
                    rank = (len(rule_host) + size, len(rule_host))
                    if best is None or rank > best[0]:
                        best = (rank, rule_host + path[:size], verdict)
        return (best[1], best[2]) if best else (None, default)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, stack, at = [], [], None  # the open intervals' keys, and their (host, size -> path -> verdict)
        for batch in batches:
            rows = batch.to_pydict()
            out = {"page_id": [], "host": [], "path": [], "rule": [], "verdict": []}
            for part, key, is_url, host, path, verdict, page_id in zip(
                *(rows[c] for c in ("part", "key", "is_url", "host", "path", "verdict", "page_id")), strict=True
            ):
                if part != at:
                    keys, stack, at = [], [], part
                while keys and not key.startswith(keys[-1]):
                    keys.pop()
                    stack.pop()
                if is_url:
                    rule, decided = judge(stack, host, path)
                    for c, v in zip(out, (page_id, host, path, rule, decided), strict=True):
                        out[c].append(v)
                    continue
                if not keys or keys[-1] != key:
                    keys.append(key)
                    stack.append((host, {}))
                paths = stack[-1][1].setdefault(len(path), {})
                if paths.get(path) != "block":
                    paths[path] = verdict
            kinds = {"page_id": batch.schema.field("page_id").type}
            yield pa.record_batch({c: pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()})

    return sweep


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict.

    ``rules`` has host, path and verdict (``allow`` or ``block``) and may be large.
    """
    spark = pages.sparkSession
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("key", _key(F.col("host")))
    salt = F.hex(F.xxhash64("page_id", F.monotonically_increasing_id()))
    urls = urls.withColumn("place", F.concat_ws("\x00", "key", F.substring("path", 1, 100), salt))

    n_ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = urls.count()
    wanted = SAMPLE_PER_RANGE * n_ranges
    sample = urls.select("place") if n <= wanted else urls.select("place").sample(min(1.0, 1.1 * wanted / n), 7)
    drawn = sorted(r["place"] for r in sample.limit(2 * wanted).collect())
    bounds = sorted({drawn[len(drawn) * i // n_ranges] for i in range(1, n_ranges)}) if drawn else []

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, x) for x in batch.column("place").to_pylist()]
            last = [bisect_right(bounds, x) for x in batch.column("upto").to_pylist()]
            yield pa.record_batch(
                {
                    **{c: batch.column(c) for c in batch.schema.names},
                    "from_part": pa.array(at, pa.int32()),
                    "to_part": pa.array(last, pa.int32()),
                }
            )

    def dealt(df: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(parts, f"{fields}, from_part int, to_part int")

    url_rows = dealt(urls.withColumn("upto", F.col("place"))).select(
        F.col("from_part").alias("part"), "key", F.lit(1).alias("is_url"), "host", "path", F.lit(None).cast("string").alias("verdict"), "page_id"
    )
    kind = pages.schema["page_id"].dataType
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), _UPPER, _LOWER)
    rule_rows = rules.select(
        host.alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict")
    ).withColumn("key", _key(F.col("host")))
    rule_rows = dealt(
        rule_rows.withColumns({"place": F.col("key"), "upto": F.concat("key", F.lit("\U0010ffff"))})
    ).select(
        F.explode(F.sequence("from_part", "to_part")).alias("part"), "key", F.lit(0).alias("is_url"), "host", "path", "verdict", F.lit(None).cast(kind).alias("page_id")
    )
    return (
        url_rows.unionByName(rule_rows)
        .repartition(n_ranges, "part")
        .sortWithinPartitions("part", "key", "is_url")
        .mapInArrow(
            _sweep(default), f"page_id {kind.simpleString()}, host string, path string, rule string, verdict string"
        )
    )
