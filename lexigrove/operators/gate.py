"""The quality gate: failures of a run against its configuration and its baseline, as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rows(df: DataFrame, gate: str, message: Column) -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), message.alias("message"))


def unexpected_codes(codes: DataFrame, allowed: DataFrame, gate: str, text: str) -> DataFrame:
    """A failure for each code that ``allowed`` doesn't have."""
    return _rows(codes.select("code").distinct().join(allowed.select("code"), "code", "left_anti"), gate, F.concat(F.lit(f"{text}: "), F.col("code")))


def too_many(issues: DataFrame, most: int, gate: str) -> DataFrame:
    """A failure if there are more issues than allowed."""
    return _rows(issues.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most), gate, F.concat(F.lit(f"more than {most} issues: "), F.col("n").cast("string")))


def metric_failures(verdicts: DataFrame, gate: str) -> DataFrame:
    """A failure for each metric (run, metric, verdict) that regressed or is missing."""
    bad = verdicts.filter(F.col("verdict").isin("regressed", "missing_current"))
    return _rows(bad, gate, F.concat_ws(" ", "run", "metric", "verdict"))


def runtime_failures(attempts: DataFrame, signatures: DataFrame) -> DataFrame:
    """Runs that never succeeded; where all did, runs whose signatures differ.

    ``attempts`` is (run, attempt, success), ``signatures`` (run, signature).  A failed run
    has no signature worth comparing, so it hides instability.
    """
    failed = attempts.groupBy("run").agg(F.bool_or("success").alias("ok")).filter("NOT ok")
    unstable = signatures.agg(F.countDistinct("signature").alias("n")).filter("n > 1")
    none_failed = failed.agg(F.count(F.lit(1)).alias("failed")).filter("failed = 0")
    stable = _rows(unstable.join(F.broadcast(none_failed), F.lit(True), "left_semi"), "stability", F.concat(F.col("n").cast("string"), F.lit(" different signatures")))  # one row
    return _rows(failed, "runtime", F.concat(F.lit("no attempt succeeded: "), F.col("run").cast("string"))).unionByName(stable)


def manual_failures(sample: DataFrame, least: int) -> DataFrame:
    """Failed entries of a manual sample (scope_id, verdict), and a failure if fewer than ``least`` passed."""
    bad = sample.filter(F.coalesce(F.col("verdict") != "pass", F.lit(True)))
    few = sample.agg(F.count_if(F.col("verdict") == "pass").alias("n")).filter(F.col("n") < least)
    return _rows(bad, "manual_sample", F.concat(F.lit("not passed: "), F.col("scope_id"))).unionByName(_rows(few, "manual_sample", F.lit(f"fewer than {least} passed")))


def gate_report(*failures: DataFrame) -> DataFrame:
    """(gate, failures, messages, status) of all failures; no rows if the gate holds."""
    every = reduce(DataFrame.unionByName, failures)
    return every.groupBy("gate").agg(F.count(F.lit(1)).alias("failures"), F.array_sort(F.collect_set("message")).alias("messages"), F.lit("fail").alias("status"))
