"""Raw sheet rows to the text-typed bronze layer."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.functions.dates import DATE_FORMATS
from saleslake.functions.text import branch_from_path, strip
from saleslake.operators.audit import raw_reason
from saleslake.operators.cleaning import add_unit, cast_text, coerce_date, trim_all, valid_dates
from saleslake.operators.contract import cell, with_contract
from saleslake.schemas import EXTRA, RAW_REQUIRED

NULL_TEXT = "nan"


def bronze_build(
    raw: DataFrame, formats: Sequence[str] = DATE_FORMATS, null_text: str = NULL_TEXT
) -> DataFrame:
    """Rows of all accepted sheets: required columns as text, FECHA as timestamp.

    Each row carries its sheet's header, so nothing is shuffled. Columns beyond the contract
    stay in the map ``_extra``.
    """
    judged = with_contract(raw, RAW_REQUIRED, _branch=branch_from_path(F.col("path")))
    accepted = judged.where((F.col("row_no") > 1) & raw_reason().isNull())
    beyond = F.array_except("names", F.array(*[F.lit(c) for c in RAW_REQUIRED]))
    extra = F.map_from_entries(F.transform(beyond, lambda n: F.struct(n, strip(cell(n)))))
    cells = accepted.select(
        *[cell(c, i).alias(c) for i, c in enumerate(RAW_REQUIRED)],
        F.col("_branch").alias("SUCURSAL"),
        F.col("path").alias("_src_file"),
        F.col("sheet_no").alias("_src_sheet_no"),
        F.col("row_no").alias("_src_row"),
        F.when(F.col("unexpected") != "", extra).alias(EXTRA),
    )
    rows = cast_text(trim_all(cells, RAW_REQUIRED), null_text, RAW_REQUIRED)
    return add_unit(valid_dates(coerce_date(rows, formats=formats)), F.col("SUCURSAL"))
