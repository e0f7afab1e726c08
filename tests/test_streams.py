"""Windows and stage states of streams, beside the queries that hold them against SQL."""

from datetime import datetime

from pyspark.sql import functions as F

from pitchlake.plans import control
from pitchlake.sources import sinks, versions
from pitchlake.streaming import stages, windows


def test_repeated_batches_change_nothing(spark):
    name, late = "stream_windows", "stream_late"
    sinks.drop_tables(spark, [name, late])
    batch = spark.createDataFrame([("a", 1, 5), ("b", 2, 5)], "start string, n int, v int")
    take = windows.into_table(name, ["start"])
    for _ in range(2):
        take(batch, 0)
        take(batch.filter("n = 2").withColumn("n", F.lit(9)), 1)
    assert sorted((r["start"], r["n"]) for r in versions.rows_of(spark, name).collect()) == [("a", 1), ("b", 9)]
    count = windows.late_into_table(late, "t", "1 hour", "10 minutes")
    first = spark.createDataFrame([(datetime.fromisoformat("2024-01-01 10:30"),), (datetime.fromisoformat("2024-01-01 05:00"),)], "t timestamp")
    # the mark is 10:20 then: a window that ended at 10:00 is over, that of 10:00 to 11:00 isn't
    second = spark.createDataFrame([(datetime.fromisoformat("2024-01-01 09:59"),), (datetime.fromisoformat("2024-01-01 10:01"),), (datetime.fromisoformat("2024-01-01 12:00"),), (None,)], "t timestamp")
    for _ in range(2):
        count(first, 0)
        count(second, 1)
    assert sorted((r["batch"], r["n"], r["late"]) for r in versions.rows_of(spark, late).collect()) == [(0, 2, 0), (1, 4, 1)]
    sinks.drop_tables(spark, [name, late])


def test_states_follow_the_control_table(spark):
    t = control.empty(spark).unionByName(spark.createDataFrame([(1, "L", 2024, "pending")], "id long, league_key string, season int, status string"), allowMissingColumns=True)
    told = [("bronze", "started", None), ("bronze", "completed", None), ("silver", "started", None), ("silver", "failed", "x" * 3000), ("silver", "completed", None), ("nothing", "failed", "y"), ("gold", "unknown", None), ("gold", "reset", None), ("gold", "failed", None)]
    state = ("pending", None, None, None)
    for i, (stage, outcome, error) in enumerate(told):
        state = stages.after(state, stage, outcome, error)
        changes = spark.createDataFrame([(1, *c, j) for j, c in enumerate(told[: i + 1])], "id long, stage string, outcome string, error string, n long").withColumn("at", F.timestamp_seconds("n"))
        assert control.folded(t, changes).select("status", "last_error", "last_error_stage").first() == state[:3]


def test_stages_without_an_answer_fail(spark, tmp_path):
    name = "stream_stages"
    sinks.drop_tables(spark, [name])
    schema = "id long, stage string, outcome string, error string, at timestamp"
    arrivals = [
        [(1, "silver", "started", None, "2024-01-01 10:00"), (2, "gold", "started", None, "2024-01-01 10:00"), (3, "gold", "failed", "e", "2024-01-01 10:00")],
        [(2, "gold", "completed", None, "2024-01-01 11:00"), (4, "gold", "reset", None, "2024-01-01 18:00")],
        [(1, "silver", "completed", None, "2024-01-01 18:30"), (5, "bronze", "started", None, "2024-01-01 18:30")],
    ]
    seen = []
    for rows in arrivals:
        spark.createDataFrame([(*r[:4], datetime.fromisoformat(r[4])) for r in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stages.kept(windows.files(spark, str(tmp_path / "in"), schema), name, "6h", "10 minutes", str(tmp_path / "cp")).awaitTermination()
        seen.append({r["id"]: (r["status"], r["last_error"]) for r in versions.rows_of(spark, name).collect()})
    assert seen[0] == {1: ("silver_running", None), 2: ("gold_running", None), 3: ("failed", "e")}
    assert seen[1] == {1: ("failed", stages.NO_ANSWER), 2: ("complete", None), 3: ("failed", "e"), 4: ("pending", None)}
    assert seen[2] == seen[1] | {1: ("silver_done", stages.NO_ANSWER), 5: ("bronze_running", None)}
    sinks.drop_tables(spark, [name])


def test_complete_windows_are_added_by_batch(spark):
    name = "stream_sessions"
    sinks.drop_tables(spark, [name])
    take = windows.added_to_table(name)
    first, second = (spark.createDataFrame(r, "user_id int, start string, n int") for r in ([(1, "a", 5), (2, "a", 6)], [(1, "b", 7)]))
    take(first.limit(0), 0)
    take(first, 1)
    before = versions.place(spark, name, {"batch": 1})
    for _ in range(2):
        take(second, 2)
    assert versions.place(spark, name, {"batch": 1}) == before
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a", 5, 1), (1, "b", 7, 2), (2, "a", 6, 1)]
    sinks.drop_tables(spark, [name])


def test_batches_of_results_are_folded_without_python_and_again_alike(spark, tmp_path):
    name, at = "stream_folded", lambda s: datetime.fromisoformat(f"2024-01-01 {s}")
    sinks.drop_tables(spark, [name])
    schema = "id long, stage string, outcome string, error string, at timestamp"
    steps = [("silver", "failed", "x" * 3000, "10:03"), ("silver", "started", None, "10:01"), ("nothing", "failed", "y", "10:05"), ("gold", "unknown", None, "10:06"), ("silver", "completed", None, "10:04")]
    first = spark.createDataFrame([(1, *s[:3], at(s[3])) for s in steps] + [(2, "gold", "started", None, at("10:00")), (3, "gold", "unknown", None, at("10:00")), (4, "gold", "failed", None, None)], schema)
    second = spark.createDataFrame([(1, "gold", "failed", "late", at("09:00")), (5, "gold", "reset", None, at("16:11"))], schema)
    take = stages.into_table(name, "6h", "10 minutes", str(tmp_path / "cp"))
    wanted = ("pending", None, None, None)
    for stage, outcome, error, _ in sorted(steps, key=lambda s: s[3]):
        wanted = stages.after(wanted, stage, outcome, error)
    shown = lambda: {r["id"]: (r["status"], r["last_error"], r["last_error_stage"], r["running"], r["changed"]) for r in versions.rows_of(spark, name).collect()}
    plan = stages.told(first)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan
    for _ in range(2):
        take(first, 0)
        assert shown() == {1: (*wanted, at("10:06")), 2: ("gold_running", None, None, "gold", at("10:00")), 3: (None, None, None, None, at("10:00"))}
    for _ in range(2):
        take(second, 1)
        assert shown() == {1: (*wanted, at("10:06")), 2: ("failed", stages.NO_ANSWER, "gold", None, at("16:00")), 3: (None, None, None, None, at("10:00")), 5: ("pending", None, None, None, at("16:11"))}
    sinks.drop_tables(spark, [name])
