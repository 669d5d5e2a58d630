from pyspark.sql import functions as F

from tidewater.operators.quality import (
    Check,
    _compact,
    accepted_values_failures,
    not_null_failures,
    relationships_failures,
    run_checks,
    unique_failures,
)


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (2, None)], "k long, v string")
    parent = spark.createDataFrame([(1,)], "k long")
    assert unique_failures(df, "k").count() == 1
    assert not_null_failures(df, "k").count() == 1
    assert {r.v for r in accepted_values_failures(df, "v", ("a", "b")).collect()} == {"z"}
    assert relationships_failures(df, "k", parent, "k").count() == 1  # k=2; NULL passes


def test_run_checks_summary(spark):
    df = spark.createDataFrame([(1, "a"), (1, "q")], "k long, v string")
    checks = [Check("unique", "m", "k"), Check("not_null", "m", "v"), Check("accepted_values", "m", "v", values=("a",))]
    res = {r.test_name: (r.failures, r.status) for r in run_checks(checks, lambda _: df).collect()}
    assert res == {"unique_m_k": (1, "fail"), "not_null_m_v": (0, "pass"), "accepted_values_m_v": (1, "fail")}


DIGEST = "0123456789abcdef" * 2


def test_compact_texts_stay_different(spark):
    texts = [DIGEST, DIGEST.upper(), DIGEST + "\n", DIGEST + "00", DIGEST[:30], "", "\x00", "\x01", "a", "é", "e"]
    texts += [bytes.fromhex(t).decode() for t in ("30" * 16, "31" * 15)] + ["30" * 16, "31" * 15]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "v string")
    got = {r.v: r.c and bytes(r.c) for r in df.select("v", _compact(F.col("v")).alias("c")).collect()}
    assert got[None] is None and len(got) == len(texts) + 1 and len(set(got.values())) == len(got)
    assert len(got[DIGEST]) == 17


def test_relationships_and_unique_of_digests(spark):
    rows = [(DIGEST, 1), (DIGEST, 1), (DIGEST.upper(), 2), ("x", 3), ("x", 3), (None, None)]
    child, parent = spark.createDataFrame(rows, "k string, n long"), spark.createDataFrame([(DIGEST, 1), (None, 3)], "k string, n long")
    frames = {"c": child, "p": parent}
    checks = [Check("relationships", "c", "k", to_model="p", to_column="k"), Check("relationships", "c", "n", to_model="p", to_column="n"),
              Check("unique", "c", "k"), Check("unique", "c", "n")]
    res = run_checks(checks, frames.__getitem__)
    assert {r.test_name: r.failures for r in res.collect()} == {
        "relationships_c_k__k__p": relationships_failures(child, "k", parent, "k").count(),  # 3
        "relationships_c_n__n__p": relationships_failures(child, "n", parent, "n").count(), "unique_c_k": 2, "unique_c_n": 2,
    }
    # rows of a key are summed up before they move, and a digest moves as 16 bytes and one
    plan = run_checks(checks[:1], frames.__getitem__)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan and "unhex" in plan.split("Join LeftAnti")[1] and "Aggregate" in plan.split("Join LeftAnti")[1]
