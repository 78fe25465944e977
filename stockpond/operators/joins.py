"""Joins that have to cope with hot keys or report what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpond.session import stage


def missing_keys(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct values of ``column`` that the reference lacks; null counts as missing."""
    wanted = df.select(F.col(column).alias("_wanted")).distinct()
    known = reference.select(F.col(reference_column).alias("_known")).distinct()
    return wanted.join(known, F.col("_wanted") == F.col("_known"), "left_anti").select(
        F.col("_wanted").alias(column)
    )


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold about ``share`` or more of the rows: at most 1 / ``share`` of them.

    A frequent-items sketch is filled per task and merged, so no row is
    shuffled. The few keys found are staged, because both sides of a join have
    to see the same ones.
    """
    wanted = max(1, int(1 / share))
    sketch = F.expr(f"approx_top_k(`{key}`, {wanted}, {wanted * 100})")
    found = (
        df.where(F.col(key).isNotNull())
        .agg(F.count(F.lit(1)).alias("_rows"), sketch.alias("_top"))
        .select("_rows", F.inline("_top"))
        .where(F.col("count") >= F.col("_rows") * share)
        .select(F.col("item").alias(key))
    )
    return stage(found, "hot-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """Equi-join in which hot keys of ``left`` are spread over ``salts`` tasks.

    Adaptive execution splits oversized partitions of ordinary joins by
    itself; use this where it cannot, for instance where adaptive execution is
    off. Only the rows of ``right`` with a hot key are repeated. The salt is a
    hash of the row, so a task that runs again sends every row to the same
    place. Works for ``inner`` and ``left`` joins and keeps every row.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = F.broadcast(hot_keys(left, key, share).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    salted_right = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0))))
    )
    return salted_left.drop("_hot").join(salted_right.drop("_hot"), [key, "_salt"], how).drop("_salt")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    share: float = 0.01,
    hot: DataFrame | None = None,
    broadcast_rows: int = 10_000,
    salts: int = 32,
) -> DataFrame:
    """Equi-join that takes the rows of hot keys out of the shuffle.

    Keys with ``share`` or more of the rows of ``left`` (``hot``, if they are
    known already) and their rows of ``right`` are staged. Where those are at
    most ``broadcast_rows``, the hot rows of ``left`` meet them without a
    shuffle, in the tasks that read them; otherwise each gets an arrival number,
    staged so that a repeated task sends it to the same place, as the salt:
    equal rows spread as well. All other rows join as usual. Without a hot key
    this is the plain join. ``left`` is read twice, so it should be a stored
    table or a cheap plan over one. Rows of a left join without a key skip the
    shuffle too. Works for ``inner`` and ``left`` joins and keeps every row.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    hot = hot_keys(left, key, share) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, key, how)
    marked = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    apart = F.coalesce("_hot", F.col(key).isNull())
    common, rest = marked.where(apart).drop("_hot"), marked.where(~apart).drop("_hot")
    matches = stage(right.join(F.broadcast(hot), key, "left_semi").select(right.columns), "hot-matches")
    if matches.count() <= broadcast_rows:
        met = common.join(F.broadcast(matches), key, how)
    else:
        number = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
        arrived = stage(common.withColumn("_salt", number), "hot-rows")
        every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        met = arrived.join(matches.withColumn("_salt", every_salt), [key, "_salt"], how).drop("_salt")
    return rest.join(right, key, how).unionByName(met)
