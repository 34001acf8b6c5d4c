"""Read-only statements: the check of a log of statements, and running one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalars import strip

# How a read-only statement may begin.
READ_PREFIXES = ("SELECT", "SHOW", "DESC", "EXPLAIN", "WITH")
# How calls of Java methods look in an analysed plan.
JAVA_CALL = re.compile(r"\b(?:try_)?reflect\(|\bjava_method\(", re.IGNORECASE)


def refusal(sql: Column) -> Column:
    """Why a logged statement is refused, NULL when it passes."""
    text = strip(sql)
    begins = F.upper(text).rlike(f"^({'|'.join(READ_PREFIXES)})")
    return (
        F.when(sql.isNull() | (text == ""), "empty statement")
        .when(~begins, "not a read-only statement")
        .when(text.contains(";"), "more than one statement")
    )


def audit_statements(log: DataFrame, column: str = "statement") -> DataFrame:
    reason = refusal(F.col(column))
    return log.withColumn("reason", reason).withColumn("allowed", F.col("reason").isNull())


def readonly_sql(spark: SparkSession, statement: str, cap: int | None = None) -> DataFrame:
    """One read-only statement as a lazy frame of all its rows, or of ``cap`` of them if that is asked for.

    A query is run as a subquery: a write hidden behind ``WITH`` does not parse there.
    Only registered relations can be read: files named in the statement do not resolve,
    and a plan that calls Java methods is refused.
    """
    text = statement.strip().removesuffix(";").strip()
    if not text or not text.upper().startswith(READ_PREFIXES) or ";" in text:
        raise PermissionError("one statement beginning with " + ", ".join(READ_PREFIXES) + " is allowed")
    if text.upper().startswith(("SELECT", "WITH")):
        text = f"SELECT * FROM (\n{text}\n) AS answer"
    files = spark.conf.get("spark.sql.runSQLOnFiles", "true")
    spark.conf.set("spark.sql.runSQLOnFiles", "false")
    try:
        answer = spark.sql(text)
    finally:
        spark.conf.set("spark.sql.runSQLOnFiles", files)
    if JAVA_CALL.search(answer._jdf.queryExecution().analyzed().toString()):
        raise PermissionError("calls of Java methods are not allowed")
    return answer if cap is None else answer.limit(cap)
