"""M1: a separable training set built with ``spark.range`` (FIXTURES.md), and L1: it as a stream of files."""
from pyspark.sql import functions as F

from stridex.schema import DEFAULT_WIDTH

PERIOD = DEFAULT_WIDTH // 20          # 20 samples per interval width
PER_KEY = 200                         # samples per (user, activity)
RUN = 50                              # samples between long gaps
LONG_GAP = 3 * DEFAULT_WIDTH
ACTS = ["Walking", "Jogging", "Standing", "Sitting"]


def m1(spark, users=12, extra_user=True):
    n_keys = users * len(ACTS)
    r = spark.range(0, n_keys * PER_KEY, numPartitions=4)
    key = (F.col("id") / F.lit(PER_KEY)).cast("long")
    k = F.col("id") % F.lit(PER_KEY)
    u = (key / F.lit(len(ACTS))).cast("long")
    a = key % F.lit(len(ACTS))
    noise = lambda s: (F.conv(F.substring(F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(s))), 1, 6),
                              16, 10).cast("double") / F.lit(float(16 ** 6)) - F.lit(0.5))
    phase = k.cast("double") * F.lit(0.9)
    base = F.lit(10**15) + (u * F.lit(len(ACTS)) + a) * F.lit(10**13)
    ts = base + k * F.lit(PERIOD) + (k / F.lit(RUN)).cast("long") * F.lit(LONG_GAP)
    x = (F.when(a == 0, F.sin(phase) * 3).when(a == 1, F.sin(phase) * 6)
         .when(a == 2, F.lit(0.2)).otherwise(F.lit(0.5)) + noise("x"))
    y = (F.when(a == 0, F.lit(9.8) + F.sin(phase) * 4).when(a == 1, F.lit(9.8) + F.sin(phase) * 12)
         .when(a == 2, F.lit(9.8)).otherwise(F.lit(1.0)) + noise("y"))
    z = (F.when(a == 0, F.lit(1.0)).when(a == 1, F.lit(2.0)).when(a == 2, F.lit(0.5)).otherwise(F.lit(9.8))
         + noise("z"))
    act = F.element_at(F.array(*[F.lit(s) for s in ACTS]), (a + 1).cast("int"))
    df = r.select(F.format_string("u%02d", u).alias("user_id"), act.alias("activity"), ts.alias("timestamp"),
                  x.alias("x"), y.alias("y"), z.alias("z"))
    if extra_user:
        extra = spark.range(0, 40, numPartitions=1).select(
            F.lit("uzz").alias("user_id"), F.lit("Upstairs").alias("activity"),
            (F.lit(10**15) + F.col("id") * F.lit(PERIOD)).alias("timestamp"),
            F.lit(1.0).alias("x"), F.lit(1.0).alias("y"), F.lit(1.0).alias("z"))
        df = df.unionByName(extra)
    return df
