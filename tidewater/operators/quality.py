"""Data-quality checks as Spark jobs.

Each check returns its failing rows as a DataFrame (pass = no rows), the
way declared schema tests work: ``unique``, ``not_null``,
``accepted_values`` (NULL passes) and ``relationships`` (NULL passes).
``run_checks`` evaluates a list of declared checks into one result frame of
(test_name, model, column_name, kind, failures, status).  Failures count
what the check query returns: failing rows for not_null, relationships and
singular checks, failing distinct values for unique and accepted_values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_LOCAL = ("not_null", "accepted_values")


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted_values | relationships | singular
    model: str
    column: str | None = None
    values: tuple = ()
    to_model: str | None = None
    to_column: str | None = None
    name: str | None = None  # singular tests carry their own name

    @property
    def test_name(self) -> str:
        if self.name:
            return self.name
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_column}__{self.to_model}"
        return f"{self.kind}_{self.model}_{self.column}"


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null values seen more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Values outside the accepted set (NULL passes), with their count."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent row (anti join; AQE splits skewed keys)."""
    parent_keys = parent.select(F.col(parent_column).alias("_pk")).where(F.col("_pk").isNotNull())
    return child.where(F.col(column).isNotNull()).join(
        parent_keys, child[column] == parent_keys["_pk"], "left_anti"
    )


def _result(check: Check, failures) -> DataFrame:
    return failures.select(
        F.lit(check.test_name).alias("test_name"),
        F.lit(check.model).alias("model"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.kind).alias("kind"),
        F.col("failures").cast("long").alias("failures"),
    )


def _rows(counted: DataFrame, group: list[Check]) -> DataFrame:
    """One result row per check from a one-row frame of counts ``_f<j>``."""
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c.test_name).alias("test_name"),
                        F.lit(c.model).alias("model"),
                        F.lit(c.column).cast("string").alias("column_name"),
                        F.lit(c.kind).alias("kind"),
                        F.col(f"_f{j}").cast("long").alias("failures"),
                    )
                    for j, c in enumerate(group)
                ]
            )
        )
    )


def _compact(text: Column) -> Column:
    """A text as bytes for grouping and joins, with md5 digests at half their length.

    The last byte tells the two forms apart, so different texts stay different.
    """
    return F.when(text.rlike(r"^[0-9a-f]{32}\z"), F.concat(F.unhex(text), F.lit(bytearray(b"\x01")))).otherwise(
        F.concat(text.cast("binary"), F.lit(bytearray(b"\x00")))
    )


def _orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row with the number of ``relationships_failures``: each task's rows are summed up by key before they move."""
    key, parent_key = F.col(column), F.col(parent_column)
    if all(isinstance(d.schema[c].dataType, T.StringType) for d, c in ((child, column), (parent, parent_column))):
        key, parent_key = _compact(key), _compact(parent_key)
    keys = child.where(F.col(column).isNotNull()).groupBy(key.alias(column)).agg(F.count(F.lit(1)).alias("_n"))
    failing = relationships_failures(keys, column, parent.select(parent_key.alias(parent_column)), parent_column)
    return failing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


# Key types whose text form is exact, so several unique checks can share one
# aggregate over (check, value as text).
_TEXT_EXACT = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)


def _unique_counts(df: DataFrame, group: list[Check]) -> DataFrame:
    """Unique checks of one model in one scan and one aggregate."""
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(j).alias("j"), _compact(F.col(c.column).cast("string")).alias("v"))
                           for j, c in enumerate(group)]))
    )
    dups = pairs.where(F.col("v").isNotNull()).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dups.agg(*[F.count_if(F.col("j") == j).alias(f"_f{j}") for j in range(len(group))])


def _bad(check: Check) -> Column:
    """Whether a row fails a row-local check."""
    col = F.col(check.column)
    return col.isNull() if check.kind == "not_null" else col.isNotNull() & ~col.isin(list(check.values))


def observe_checks(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with the failing rows of its row-local checks counted as it is written.

    Returns the frame to write, and a function that gives failing rows by test
    name once it is written.  The counts are taken in the writing stage itself,
    where Spark counts each task once, also if it was tried again.
    """
    checks = [c for c in checks if c.kind in ROW_LOCAL]
    if not checks:
        return df, dict
    seen = Observation()
    watched = df.observe(seen, *[F.count_if(_bad(c)).alias(f"_f{j}") for j, c in enumerate(checks)])
    return watched, lambda: {c.test_name: int(seen.get[f"_f{j}"] or 0) for j, c in enumerate(checks)}


def run_checks(
    checks: list[Check],
    model: Callable[[str], DataFrame],
    singular: dict[str, Callable[[], DataFrame]] | None = None,
    observed: dict[str, int] | None = None,
) -> DataFrame:
    """Evaluate ``checks`` against models looked up by name; one row per check.

    Row-local checks (not_null, accepted_values) that were ``observed`` while
    their model was written (failing rows by test name) read nothing, unless
    accepted_values has failing rows, whose distinct values are then counted.
    The other row-local checks of one model share a single scan; unique checks
    of one model share one aggregate; relationships are anti joins; singular
    checks count the rows of their query.
    """
    singular, observed = singular or {}, observed or {}
    parts: list[DataFrame] = []
    row_local: dict[str, list[Check]] = {}
    uniques: dict[str, list[Check]] = {}
    known: list[Check] = []
    for c in checks:
        n = observed.get(c.test_name) if c.kind in ROW_LOCAL else None
        if n == 0 or (n is not None and c.kind == "not_null"):
            known.append(c)
        elif c.kind in ROW_LOCAL:
            row_local.setdefault(c.model, []).append(c)
        elif c.kind == "unique":
            uniques.setdefault(c.model, []).append(c)
    if known:
        spark = model(known[0].model).sparkSession
        rows = [(c.test_name, c.model, c.column, c.kind, observed[c.test_name]) for c in known]
        parts.append(spark.createDataFrame(
            rows, "test_name string, model string, column_name string, kind string, failures long"
        ).coalesce(1))
    for model_name, group in row_local.items():
        aggs = []
        for j, c in enumerate(group):
            # accepted_values reports the distinct failing values, not_null the failing rows
            failing = F.count_if(_bad(c)) if c.kind == "not_null" else F.count_distinct(F.when(_bad(c), F.col(c.column)))
            aggs.append(failing.alias(f"_f{j}"))
        parts.append(_rows(model(model_name).agg(*aggs), group))
    for model_name, group in uniques.items():
        df = model(model_name)
        shared = [c for c in group if isinstance(df.schema[c.column].dataType, _TEXT_EXACT)]
        if len(shared) > 1:
            parts.append(_rows(_unique_counts(df, shared), shared))
        for c in group:
            if len(shared) <= 1 or c not in shared:
                parts.append(_result(c, unique_failures(df, c.column).agg(F.count(F.lit(1)).alias("failures"))))
    for c in checks:
        if c.kind == "relationships":
            parts.append(_result(c, _orphans(model(c.model), c.column, model(c.to_model), c.to_column)))
        elif c.kind == "singular":
            parts.append(_result(c, singular[c.test_name]().agg(F.count(F.lit(1)).alias("failures"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))
