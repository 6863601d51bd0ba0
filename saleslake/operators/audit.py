"""Run audit: one row per unit with counters, status and reason."""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.dates import DATE_FORMATS, to_ts
from saleslake.functions.text import branch_from_path, strip
from saleslake.operators.contract import cell, with_contract
from saleslake.schemas import RAW_REQUIRED, UNIT


def load_audit(
    df: DataFrame,
    unit: Sequence[str],
    checks: dict[str, Column],
    reason: Column,
    notes: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows, rows failing each check, and the reason why a unit failed (null if it did not).

    ``reason`` and ``notes`` are evaluated per row, the largest value of a unit is reported. The few
    values that a unit has are keys of a plain count, so that partial aggregation needs no sort.
    """
    texts = (notes or {}) | {"reason": reason}
    failing = [F.coalesce(bad, F.lit(False)).alias(name) for name, bad in checks.items()]
    rows = df.select(*unit, *failing, *[c.alias(name) for name, c in texts.items()])
    counters = [F.count_if(F.col(name)).alias(name) for name in checks]
    counted = rows.groupBy(*unit, *texts).agg(F.count(F.lit(1)).alias("row_count"), *counters)
    audited = counted.groupBy(*unit).agg(
        *[F.sum(name).alias(name) for name in ("row_count", *checks)],
        *[F.max(name).alias(name) for name in texts],
    )
    status = F.when(F.col("reason").isNull(), "ok").otherwise("failed")
    return audited.withColumn("status", status)


def raw_reason() -> Column:
    """Why a raw row's sheet is rejected, after ``with_contract`` with its ``_branch``; null for an accepted one."""
    missing = F.col("missing")
    return (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("repeated"), F.lit("duplicate_columns"))
        .when(F.col("_branch") == "", F.lit("empty_branch"))
        .when(missing != "", F.concat(F.lit("missing_columns: "), missing))
    )


def raw_audit(raw: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Audit per workbook sheet: header record included in the contract, not in the counts.

    ``unexpected`` names the columns beyond the contract, also of an accepted sheet.
    """
    judged = with_contract(raw, RAW_REQUIRED, _branch=branch_from_path(F.col("path")))
    data_row = F.col("row_no") > 1
    bad_date = data_row & to_ts(strip(cell("FECHA", RAW_REQUIRED.index("FECHA"))), formats).isNull()
    beyond = F.when(F.col("unexpected") != "", F.col("unexpected"))
    audited = load_audit(
        judged,
        ["path", "sheet"],
        {"data_rows": data_row, "bad_dates": bad_date},
        raw_reason(),
        {"unexpected": beyond},
    )
    undated = F.col("reason").isNull() & (F.col("data_rows") > 0) & (F.col("bad_dates") == F.col("data_rows"))
    return audited.withColumns(
        {
            "reason": F.when(undated, F.lit("no_valid_dates")).otherwise(F.col("reason")),
            "status": F.when(undated, F.lit("empty")).otherwise(F.col("status")),
        }
    ).drop("row_count")


def unit_audit(report: DataFrame, written: DataFrame) -> DataFrame:
    """Audit per branch-month: input and output rows, lines without a rate, columns, status.

    ``report`` is the contract of the input files and counts their rows, ``written`` counts the
    rows of the files that the run has added (``rows_out`` and ``rows_without_rate``). Both come from
    footers, so the audit reads no row again.
    """
    same = [F.col(u).eqNullSafe(F.col(f"_{u}")) for u in UNIT]
    counted = written.select(*[F.col(u).alias(f"_{u}") for u in UNIT], F.col("rows_out").alias("_out"), "rows_without_rate")
    audited = report.join(counted, same, "left")
    rows_out = F.coalesce("_out", F.lit(0))
    failed = F.col("reason").isNotNull()
    reason = F.coalesce("reason", F.when(rows_out == 0, F.lit("no_output_rows")))
    status = F.when(failed, "failed").when(rows_out == 0, "empty").otherwise("ok")
    return audited.select(
        *UNIT,
        F.col("row_count").alias("rows_in"),
        rows_out.alias("rows_out"),
        "rows_without_rate",
        F.when(F.col("unexpected") != "", F.col("unexpected")).alias("unexpected"),
        reason.alias("reason"),
        status.alias("status"),
    )


def of_run(audit: DataFrame, run_id: str | None = None) -> DataFrame:
    """The audit rows of one run, told from those of other runs by its id and the time of the audit."""
    return audit.withColumns({"run_id": F.lit(run_id or uuid.uuid4().hex), "run_at": F.current_timestamp()})
