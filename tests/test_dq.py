import pytest
from pyspark.sql import functions as F

from ratelake.config import EngineConfig
from ratelake.operators import consensus as cons
from ratelake.operators import dq, fact

from .helpers import day
from .test_validation import CL, ER, FR, stg


@pytest.fixture
def staged(spark):
    return stg(spark, (FR, "EUR", 1, 1.0), (ER, "EUR", 1, 1.1), (FR, "GBP", 1, 2.0),
               (CL, "GBP", 1, 2.0))


@pytest.fixture
def built(staged):
    return fact.build_fact([staged], cons.build_consensus([staged]))


def failures(df):
    return {(r.check, r.column): r.failures for r in df.collect()}


def test_row_checks_in_one_scan(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -1.0), (None, None)], "k string, v double")
    checks = [dq.not_null("k"), dq.accepted_values("k", ["a"]), dq.expression_true("v", "> 0")]
    out = dq.row_checks(df, checks)
    assert failures(out) == {("not_null", "k"): 1, ("accepted_values", "k"): 1,
                             ("expression_true > 0", "v"): 1}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_key_and_table_checks(spark):
    df = spark.createDataFrame([(day("2024-01-01"), "a")] * 2 + [(day("2024-01-02"), "b")],
                               "d date, k string")
    assert failures(dq.unique_combination(df, ["d", "k"])) == {("unique_combination", "d,k"): 1}
    assert failures(dq.recency(df, "d", day("2024-01-09"), 7)) == {("recency", "d"): 0}
    assert failures(dq.recency(df, "d", day("2024-01-10"), 7)) == {("recency", "d"): 1}
    assert failures(dq.recency(df.limit(0), "d", day("2024-01-10"), 7)) == {("recency", "d"): 1}
    assert failures(dq.row_count_equals(df, 3)) == {("row_count", "*"): 0}
    assert failures(dq.min_distinct(df, "k", 3)) == {("min_distinct", "k"): 1}


def test_severity(spark):
    df = spark.createDataFrame([(0.95,), (0.85,), (0.5,)], "ok_rate double")
    assert [r.grade for r in dq.severity(df, "ok_rate", 0.9, 0.8).collect()] == [
        "pass", "warn", "error"]


def test_declared_suites_have_56_checks(staged, built):
    sources = EngineConfig().sources
    report = dq.declared_suites(
        {s.name: staged.where(F.col("source") == s.name) for s in sources},
        cons.build_consensus([staged]), built)
    got = report.collect()
    assert len(got) == 56 and all(r.failures == 0 for r in got)


def test_contract_passes_good_rows(built):
    assert dq.enforce_contract(built).count() == built.count() == 1
    assert all(r.failures == 0 for r in dq.contract_violations(built).collect())


@pytest.mark.parametrize("column, bad", [
    ("base_currency", "EUR"), ("exchange_rate", -1.0), ("exchange_rate", 2e10),
    ("extraction_id", None), ("severity", "WARNING"), ("consensus_variance", 0.1)])
def test_contract_aborts_the_job(built, column, bad):
    kind = built.schema[column].dataType
    broken = built.withColumn(column, F.lit(bad).cast(kind))
    with pytest.raises(Exception, match="fact contract violated"):
        dq.enforce_contract(broken).collect()
    with pytest.raises(Exception, match="fact contract violated"):
        dq.enforce_contract(broken).select("rate_date").write.format("noop").mode(
            "overwrite").save()
    assert sum(r.failures for r in dq.contract_violations(broken).collect()) >= 1


def test_contract_checks_columns(built):
    with pytest.raises(dq.ContractError):
        dq.enforce_contract(built.withColumn("exchange_rate", F.col("exchange_rate").cast("float")))
    with pytest.raises(dq.ContractError):
        dq.enforce_contract(built.drop("model_name"))
