"""Aggregation helpers that stay exact and skew-safe at scale.

* ``ratio_half_up`` rounds a ratio of two non-negative integers half-up with
  integer arithmetic, so the result does not depend on float formatting.
* ``exact_median`` computes the interpolating median (as pandas) without
  gathering a group's values in one task: values are counted per fine bucket
  (a bounded table), the buckets holding the middle ranks are located with a
  running sum over that small table, and only those buckets are read again.
* ``pick_per_key`` keeps one row per key through ``max``/``min`` of a struct,
  an aggregate with map-side partial aggregation (sort-based, as the buffer
  is a struct), so a hot key is cut to one row per mapper before the shuffle
  and never lands whole in one task or window buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DEC = "decimal(38,0)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative integers (null when b is 0)."""
    a_, b_ = a.cast(_DEC), b.cast(_DEC)
    return F.when(b_ != 0, ((a_ - F.pmod(a_, b_)) / b_).cast("long"))


def _millionths(c) -> Column:
    """A number in whole millionths, as an exact decimal without places."""
    return (_c(c).cast("decimal(24,6)") * F.lit(1_000_000)).cast(_DEC)


def ratio_half_up(num, den, places: int = 4) -> Column:
    """round(num / den, places) half-up for num >= 0, den > 0 of at most six
    decimals; null if den == 0."""
    scale = 10 ** places
    n, d = _millionths(num), _millionths(den)
    q = int_div(n * F.lit(2 * scale) + d, d * F.lit(2))
    return q.cast("double") / F.lit(float(scale))


def exact_median(df: DataFrame, group_cols: list[str], value_col: str,
                 out_col: str = "median", buckets: int = 10_000) -> DataFrame:
    """Interpolating median of ``value_col`` per group; one row per non-empty group.

    Pass 1 counts rows per (group, bucket): ``buckets`` equal parts of the
    group's own range, so the table is bounded whatever the column holds, and
    map-side partial aggregation collapses a hot value to one row per mapper.
    A running sum over that table finds the bucket of each middle rank.  Pass 2
    reads only rows of those (at most two) buckets per group and ranks their
    distinct values.
    """
    g = list(group_cols)
    vals = df.select(*g, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    # one row a group: its range
    span = vals.groupBy(*g).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    part = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * buckets)
    vals = (vals.join(span, g).withColumn("_b", F.when(F.col("_hi") > F.col("_lo"), part).otherwise(0).cast("long"))
                .drop("_lo", "_hi"))
    counts = vals.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*g)
    counts = (counts.withColumn("_cum", F.sum("_n").over(run))
                    .withColumn("_tot", F.sum("_n").over(whole)))
    ranks = counts.select(*g, "_b", "_n", "_cum",
                          F.array(int_div(F.col("_tot") - 1, F.lit(2)),
                                  int_div(F.col("_tot"), F.lit(2))).alias("_ks"))
    ranks = ranks.select(*g, "_b", "_n", "_cum", F.posexplode("_ks").alias("_which", "_k"))
    targets = (ranks.where((F.col("_cum") - F.col("_n") <= F.col("_k")) & (F.col("_k") < F.col("_cum")))
                    .select(*g, "_b", "_which", (F.col("_k") - (F.col("_cum") - F.col("_n"))).alias("_off")))
    inside = vals.join(targets.select(*g, "_b").distinct(), [*g, "_b"], "left_semi")
    distinct_vals = inside.groupBy(*g, "_b", "_v").agg(F.count(F.lit(1)).alias("_m"))
    run_b = Window.partitionBy(*g, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    distinct_vals = distinct_vals.withColumn("_cm", F.sum("_m").over(run_b))
    picked = (distinct_vals.join(targets, [*g, "_b"])
                           .where((F.col("_cm") - F.col("_m") <= F.col("_off")) & (F.col("_off") < F.col("_cm"))))
    return picked.groupBy(*g).agg(
        ((F.max(F.when(F.col("_which") == 0, F.col("_v"))) +
          F.max(F.when(F.col("_which") == 1, F.col("_v")))) / 2).alias(out_col))


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column], payload: list[str],
                 latest: bool = True) -> DataFrame:
    """One row per key: the greatest (``latest``) or smallest ``order`` tuple.

    ``order`` must end in a unique tie-break so the choice is deterministic.
    """
    parts = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(p).alias(p) for p in payload]
    agg = F.max if latest else F.min
    picked = df.groupBy(*keys).agg(agg(F.struct(*parts)).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick.{p}").alias(p) for p in payload])


# Money is summed as exact integer cents: a long aggregation buffer stays in
# the fixed-width part of the row, whereas sum(decimal(18,2)) widens to
# decimal(28,2) and is re-encoded as bytes on every update.
def to_cents(amount, scale: int = 2) -> Column:
    """Exact unscaled value of a decimal amount with ``scale`` places."""
    return (_c(amount).cast(f"decimal(18,{scale})") * F.lit(10 ** scale)).cast("long")


def from_cents(cents, scale: int = 2, precision: int = 38) -> Column:
    """Decimal(precision, scale) from an unscaled long; overflow raises (ANSI)."""
    from decimal import Decimal
    return (_c(cents).cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")


def sum_money(amount, scale: int = 2, precision: int = 38) -> Column:
    """sum() of a decimal amount, exact, through a long buffer."""
    return from_cents(F.sum(to_cents(amount, scale)), scale, precision)


def avg_money_half_up(amount, places: int = 2, scale: int = 4) -> Column:
    """round(avg(amount), places) half-up, exact for non-negative amounts of
    at most ``scale`` decimals, any group size: integer arithmetic on units of
    the last decimal; only the average is rounded, never an amount."""
    units = F.sum(to_cents(amount, scale)).cast(_DEC)
    whole = F.count(_c(amount)).cast(_DEC) * F.lit(10 ** scale)
    q = int_div(units * F.lit(2 * 10 ** places) + whole, whole * F.lit(2))
    return q.cast("double") / F.lit(float(10 ** places))


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                salts: int = 16) -> DataFrame:
    """Join a large side to a one-row-per-key side so that a key holding a
    large share of ``big`` is spread over ``salts`` join keys.

    Each row of ``big`` gets a salt from a hash of its own values
    (deterministic, so a retried task computes the same salt); ``small`` is
    replicated once per salt (its size times ``salts``).  ``how`` must keep
    ``big`` on the left: inner, left or left_semi.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts)).cast("int")
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, [*on, "_salt"], how).drop("_salt")
