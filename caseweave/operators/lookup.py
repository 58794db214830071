"""Joins against a keyed table that stay balanced when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseweave.session import store_stage

MAX_SALTS = 4096
HOT_KEY_ROWS = 1_000_000
#: Hot keys are broadcast; with more of them than this the threshold rises, so their number is bounded.
HOT_KEYS = 1_000_000
#: Bits of the filter of wanted keys: so many for each key, and at most so many.
FILTER_BITS_PER_KEY, FILTER_BITS = 16, 1 << 28
_BITMAP_BITS = 8 * 4096  # of one bitmap of Spark's bitmap functions

_KEY, _SALT, _SALTS, _RANK = "_key", "_salt", "_salts", "_rank"


def hot_keys(df: DataFrame, key: Column, min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``(_key, _salts)``: every key with ``min_rows`` rows or more, and the number of salts to spread it over.

    Counts are exact and merged map-side; there can be one such key for each ``min_rows`` rows, no more.
    """
    counts = df.select(key.alias(_KEY)).where(F.col(_KEY).isNotNull()).groupBy(_KEY).agg(F.count(F.lit(1)).alias("n"))
    salts = F.least(F.ceil(F.col("n") / min_rows), F.lit(MAX_SALTS)).cast("int")
    return counts.where(F.col("n") >= min_rows).select(_KEY, salts.alias(_SALTS))


def _places(key: Column, n_bits: int) -> list[Column]:
    """The bits of a key in a filter: two hashes."""
    return [F.pmod(F.xxhash64(*extra, key), F.lit(n_bits).cast("bigint")) for extra in ((), (F.lit("second"),))]


def key_filter(df: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """A Bloom filter of the keys: rows ``(bucket, bitmap)``, its bits, and the rows with a key.

    The bitmaps are built where the keys are and merged by bucket; the driver sees none of them.
    """
    keys = df.select(F.col(key).alias(_KEY)).where(F.col(_KEY).isNotNull())
    n = keys.count()
    n_bits = max(_BITMAP_BITS, min(FILTER_BITS, 1 << max(0, FILTER_BITS_PER_KEY * n - 1).bit_length()))
    places = keys.select(F.explode(F.array(*_places(F.col(_KEY), n_bits))).alias("at"))
    bitmaps = places.groupBy(F.floor(F.col("at") / _BITMAP_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(_BITMAP_BITS))).alias("bitmap")
    )
    return store_stage(bitmaps, "key-filter"), n_bits, n


def only_wanted(dims: DataFrame, key: str, wanted: DataFrame, n_bits: int) -> DataFrame:
    """The rows of ``dims`` whose key may be in the filter; tested at the scan, before any shuffle."""
    kept = dims
    for i, place in enumerate(_places(F.col(key), n_bits)):
        bucket, bitmap = f"_bucket{i}", f"_bitmap{i}"
        # at most FILTER_BITS / 8 bytes, whatever the number of keys
        table = F.broadcast(wanted.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
        bit = F.pmod(place, F.lit(_BITMAP_BITS))
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
        kept = kept.join(table, F.floor(place / _BITMAP_BITS) == F.col(bucket)).where(is_set).drop(bucket, bitmap)
    return kept


def lookup_join(
    facts: DataFrame,
    dims: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_by: str,
    how: str = "inner",
    first_by: list[Column] | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Join every fact with the one ``dims`` row of its key.

    Facts of a frequent key are spread over several tasks by a salt taken from ``spread_by``
    (a column that differs from fact to fact) and only the ``dims`` rows of those keys are
    repeated, once per salt.  Facts without a key are spread as well.

    With ``first_by``, ``dims`` may hold several rows per key and the first in that order is
    used.  Copies are dropped before the shuffle, and the join reuses that shuffle.

    ``dims`` rows that no fact points at are dropped at the scan by a filter of the wanted keys, unless there
    are so many of those that it would let most rows through.
    """
    wanted, n_bits, n_keys = key_filter(facts, fact_key)
    if 2 * n_keys <= n_bits:
        dims = only_wanted(dims, dim_key, wanted, n_bits)
    # at most HOT_KEYS rows, found once and broadcast to both sides
    hot = store_stage(hot_keys(facts, F.col(fact_key), max(hot_key_rows, n_keys // HOT_KEYS)), "hot-keys")
    spread = F.xxhash64(F.col(spread_by))
    n_salts = F.coalesce(F.col(_SALTS), F.lit(1))

    def with_salts(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(_KEY, F.col(key)).join(F.broadcast(hot), _KEY, "left")

    left = with_salts(facts, fact_key).withColumn(
        _SALT,
        F.when(F.col(_KEY).isNull(), F.pmod(spread, F.lit(MAX_SALTS)))
        .otherwise(F.pmod(spread, n_salts))
        .cast("int"),
    ).drop(_SALTS)
    right = (
        with_salts(dims.where(F.col(dim_key).isNotNull()), dim_key)
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), n_salts - 1)))
        .drop(_SALTS)
    )
    if first_by:
        first = W.partitionBy(_KEY, _SALT).orderBy(*first_by)
        right = right.withColumn(_RANK, F.row_number().over(first)).where(F.col(_RANK) == 1)
        right = right.drop(_RANK)
    return left.join(right, [_KEY, _SALT], how).drop(_KEY, _SALT)
