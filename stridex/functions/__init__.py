"""Column expressions shared by the operators. All are built-in Spark expressions (JVM side, codegen)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LABELS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(t: str, width: int | str) -> Column:
    """Exact integer floor of ``t / width`` on longs.

    ``div`` truncates towards zero, so subtract the non-negative remainder first; no detour through double,
    which is inexact for nanosecond epochs above 2**53. ``t`` and ``width`` are SQL snippets or column names.
    """
    return F.expr(f"(({t}) - pmod({t}, {width})) div ({width})")


def trunc_to_long(c) -> Column:
    """Java's double -> long narrowing: cut towards zero (ANSI cast, so NaN must be rejected upstream)."""
    return col(c).cast("long")


def resultant(x="x", y="y", z="z") -> Column:
    x, y, z = col(x), col(y), col(z)
    return F.sqrt(x * x + y * y + z * z)


def label_index(activity="activity") -> Column:
    """Activity text -> class number as double, NULL outside the domain."""
    a = col(activity)
    expr = F.lit(None).cast("double")
    for k in reversed(range(len(LABELS))):
        expr = F.when(a == F.lit(LABELS[k]), F.lit(float(k))).otherwise(expr)
    return expr


def label_text(label="label") -> Column:
    """Class number -> activity text; a number outside 0..3 raises, never a guess."""
    v = col(label)
    expr = F.raise_error(F.concat(F.lit("not an activity class: "), v.cast("string"))).cast("string")
    for k in reversed(range(len(LABELS))):
        expr = F.when(v == F.lit(float(k)), F.lit(LABELS[k])).otherwise(expr)
    return expr


EXPLODE_BLOCK = 4096


def explode_range(df: DataFrame, lo: str, hi: str, name: str, block: int = EXPLODE_BLOCK,
                  spread: list[str] | None = None) -> DataFrame:
    """One row per integer ``lo .. hi`` (inclusive; SQL snippets over ``df``), as column ``name`` (long). ``spread`` names
    columns that identify a row: then blocks are dealt to tasks by them, so one long range is expanded by many tasks.

    Two levels -- blocks of ``block`` values, then the values of each block -- so no array grows with the range:
    a month-long session has millions of intervals, and one ``sequence`` over them would be one huge array.
    """
    b = int(block)
    nblk = (f"CASE WHEN ({hi}) >= ({lo}) THEN sequence(0L, (({hi}) - ({lo})) div {b}) "
            f"ELSE cast(array() AS array<bigint>) END")
    blocks = df.select("*", F.explode(F.expr(nblk)).alias("_blk"))
    if spread:                      # a stated number of partitions: few rows of long ranges must not be put together
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = blocks.repartition(n, *spread, "_blk")
    first = F.expr(f"({lo}) + _blk * {b}")
    last = F.expr(f"least(({lo}) + _blk * {b} + {b - 1}, {hi})")
    return blocks.select("*", F.explode(F.sequence(first, last)).alias(name)).drop("_blk")
