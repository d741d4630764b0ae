"""Quantiles by counting against plain sorting."""

import math

import numpy as np
import pytest

from riskloom.operators import selection
from riskloom.operators.prepare import prepared_features
from riskloom.operators.selection import from_ordered_bits, ordered_bits, selected_quantiles

ODD = [0.0, -0.0, 1.5, -1.5, 5e-324, -5e-324, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan"), 0.1]


def test_bits_order_like_the_values():
    draw = np.random.default_rng(0).normal(size=500) * 10.0 ** np.random.default_rng(1).integers(-300, 300, 500)
    values = np.sort(np.r_[ODD, draw])
    bits = ordered_bits(values)
    assert (np.diff(bits.astype(object)) >= 0).all()
    for v, b in zip(values.tolist(), bits.tolist(), strict=True):
        assert from_ordered_bits(b) == v or math.isnan(v) and math.isnan(from_ordered_bits(b))


@pytest.mark.parametrize(("few", "fraction"), [(1 << 16, 0.5), (1 << 16, 0.9), (40, 0.25), (0, 1.0)])
def test_quantiles_equal_sorting(spark, monkeypatch, few, fraction):
    monkeypatch.setattr(selection, "FEW_VALUES", few)
    draw = np.random.default_rng(2)
    rows = []
    for k in range(900):
        tied = float(draw.integers(-3, 4))  # a third of all rows hold one value
        rows.append(("ab"[k % 2], 7.25 if k % 3 == 0 else tied, float(draw.normal()) if k % 5 else None, None))
    rows += [(None, 2.0, -4.0, None), ("one", 3.0, None, None)]
    df = spark.createDataFrame(rows, "split string, x double, y double, z double").repartition(5)
    found = selected_quantiles(df, ["x", "y", "z"], "split", fraction)
    assert set(found) == {"a", "b", "one", None}
    for group, columns in found.items():
        for at, c in enumerate("xyz", start=1):
            values = [r[at] for r in rows if r[0] == group and r[at] is not None]
            assert columns[c] == (pytest.approx(np.quantile(values, fraction), abs=1e-15) if values else None)


def test_columns_without_gaps_and_empty_frames(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, 5.0)], "split string, x double, y double")
    assert selected_quantiles(df, ["x", "y"], "split", only_gaps=True) == {"a": {"y": 5.0}}
    assert selected_quantiles(df.limit(0), ["x"], "split") == {} == selected_quantiles(df, [], "split")
    infinite = spark.createDataFrame([("a", v) for v in ODD], "split string, x double")
    assert selected_quantiles(infinite, ["x"], "split") == {"a": {"x": 5e-324}}
    assert math.isnan(selected_quantiles(infinite, ["x"], "split", 1.0)["a"]["x"])


def test_prepared_rows_need_no_exchange(spark):
    rows = [(k, ("train", "val", "test")[k % 3], k % 2 == 0, None if k % 4 == 0 else float(k), k % 5 == 0 or None) for k in range(40)]
    df = spark.createDataFrame(rows, "transaction_id long, split string, label boolean, amount double, is_night boolean")
    for fit_on in (None, "train"):
        out = prepared_features(df, ["amount", "is_night", "absent"], fit_on=fit_on)
        assert "Exchange" not in out._jdf.queryExecution().toString()
        for r in out.collect():
            if r["transaction_id"] % 4 == 0:
                split = fit_on or r["split"]
                assert r["amount"] == np.median([x[3] for x in rows if x[1] == split and x[3] is not None])
            assert r["is_night"] == int(r["transaction_id"] % 5 == 0)
