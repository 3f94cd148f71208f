"""Shared expressions: exact floor division, label maps, two-level range explode."""
import pytest

from stridex.functions import explode_range, floor_div, label_index, label_text


def test_floor_div_exact_and_negative(spark):
    big = 1_704_067_207_179_575_123
    rows = spark.createDataFrame([(big,), (-7,), (7,), (-10,), (0,)], "t long")
    got = [r[0] for r in rows.select(floor_div("t", 5)).collect()]
    assert got == [big // 5, -2, 1, -2, 0]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_explode_range(spark, block):
    df = spark.createDataFrame([(1, 0, 7), (2, 5, 5), (3, 4, 2), (4, -3, 1)], "k int, lo long, hi long")
    got = sorted((r.k, r.v) for r in explode_range(df, "lo", "hi", "v", block=block).collect())
    want = sorted([(1, v) for v in range(0, 8)] + [(2, 5)] + [(4, v) for v in range(-3, 2)])
    assert got == want


def test_labels_roundtrip_and_unknown(spark):
    df = spark.createDataFrame([("Walking",), ("Jogging",), ("Standing",), ("Sitting",), ("Upstairs",)], "a string")
    idx = [r[0] for r in df.select(label_index("a")).collect()]
    assert idx == [0.0, 1.0, 2.0, 3.0, None]
    back = [r[0] for r in df.select(label_index("a").alias("l")).where("l is not null")
            .select(label_text("l")).collect()]
    assert back == ["Walking", "Jogging", "Standing", "Sitting"]


def test_rejected_samples_audit(spark):
    from stridex.sources.readers import rejected_samples, valid_axes, validate_samples
    rows = [("u", "Walking", 1, 1.0, 1.0, 1.0), (None, "Walking", 2, 1.0, 1.0, 1.0),
            ("u", "Walking", None, 1.0, 1.0, 1.0), ("u", "Walking", 4, float("nan"), 1.0, 1.0),
            ("u", "Walking", 5, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "user_id string, activity string, timestamp long, x double, y double, z double")
    assert validate_samples(df).count() == 3
    assert valid_axes(validate_samples(df)).count() == 1
    assert rejected_samples(df).count() == 4


def test_cli_rejects_missing_arguments():
    import pytest as _pytest

    from stridex.__main__ import _parser
    with _pytest.raises(SystemExit):
        _parser().parse_args(["train"])
    args = _parser().parse_args(["stream", "--live", "a", "--model", "m", "--out", "o"])
    assert args.every == "5 seconds" and not args.stateless and args.kind == "forest"
