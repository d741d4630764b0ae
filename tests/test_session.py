"""Stored frames, also where Spark's configuration names no folder."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from riskloom.session import SHUFFLE_CLEANUP, stored, stored_alone

BARE = """
import os
from riskloom.session import local_session, shared_folder, stored
from riskloom.operators.ordering import ranked
spark = local_session("bare", "2")
assert spark.conf.get("spark.checkpoint.dir", None) is None
df = stored(spark.range(100).selectExpr("id", "id % 7 AS k"))
assert df.where("k = 3").count() == 14
assert sorted(r[0] for r in ranked(df, ["k", "id"]).select("_rank").collect()) == list(range(100))
print("FOLDER", shared_folder(spark) + "/riskloom-" + spark.sparkContext.applicationId)
"""


def test_without_a_configured_folder(tmp_path):
    (tmp_path / "spark-defaults.conf").write_text("")
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run([sys.executable, "-c", BARE], env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    folder = done.stdout.split("FOLDER ")[1].strip()
    assert not os.path.exists(folder)  # removed when the process ended


def test_stored_frames_are_pruned(spark):
    df = stored(spark.range(50).select("id", F.col("id").cast("string").alias("text"), F.lit(None).cast("int").alias("none")))
    assert df.dtypes == [("id", "bigint"), ("text", "string"), ("none", "int")]
    plan = df.where("id > 40").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,40)]" in plan and "ExistingRDD" not in plan
    assert stored(df.limit(0)).count() == 0


SHUFFLES = """
import pathlib, sys, time
from riskloom.session import local_session, stored
spark = local_session("shuffles", "2")
df = stored(spark.range(1000).repartition(4, "id").groupBy("id").count())
files = lambda: list(pathlib.Path(sys.argv[1]).rglob("shuffle_*.data"))
end = time.time() + 20
while files() and time.time() < end:
    time.sleep(0.2)
print("LEFT", len(files()), df.count())
"""


def test_stored_frames_leave_no_shuffle_files(tmp_path):
    env = {**os.environ, "SPARK_LOCAL_DIRS": str(tmp_path), "PYTHONPATH": os.pathsep.join(sys.path)}
    done = subprocess.run([sys.executable, "-c", SHUFFLES, str(tmp_path)], env=env, capture_output=True, text=True, timeout=180)
    assert "LEFT 0 1000" in done.stdout, done.stdout + done.stderr[-2000:]


def test_the_setting_for_shuffle_files_returns(spark):
    for value in (None, "false", "true"):
        if value is not None:
            spark.conf.set(SHUFFLE_CLEANUP, value)
        stored(spark.range(3))
        assert spark.conf.get(SHUFFLE_CLEANUP, None) == value
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_stored_alone_deletes_what_led_to_it(spark):
    def within():
        first = stored(spark.range(20))
        second = stored_alone(spark, lambda: stored(first.where("id > 4")).where("id > 9"))
        made.extend([first, second])
        return second.selectExpr("id * 2 AS id")

    made, before = [], stored(spark.range(3))
    result = stored_alone(spark, within)
    assert sorted(r["id"] for r in result.collect()) == list(range(20, 40, 2))
    folders = [os.path.dirname(df.inputFiles()[0].removeprefix("file://")) for df in (*made, result, before)]
    assert [os.path.exists(f) for f in folders] == [False, False, True, True] and before.count() == 3
    with pytest.raises(ZeroDivisionError):
        stored_alone(spark, lambda: 1 // 0)
    assert stored(spark.range(2)).count() == 2


@pytest.mark.parametrize("name", ["prepared_features", "evaluation_report", "drift_report"])
def test_registered_plans_scan_no_rdd(spark, tables, name):
    from riskloom.plans.queries import all_queries

    plan = all_queries()[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan
