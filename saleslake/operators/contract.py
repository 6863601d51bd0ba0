"""Column contracts: which required columns are missing, which columns were not expected."""

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.text import NOT_PLAIN, strip


_BLANK = "\t"  # a mark for a blank name: no plain character


class ContractError(ValueError):
    """A table that lacks required columns."""


@dataclass(frozen=True)
class ContractReport:
    missing: tuple[str, ...]
    unexpected: tuple[str, ...]

    @property
    def accepted(self) -> bool:
        return not self.missing

    def require(self, what: str) -> None:
        if self.missing:
            raise ContractError(f"{what}: missing columns {', '.join(self.missing)}")


def check_contract(df: DataFrame, required: Iterable[str]) -> ContractReport:
    """Contract of one table; needs its schema only, never its rows."""
    wanted, present = set(required), set(df.columns)
    return ContractReport(tuple(sorted(wanted - present)), tuple(sorted(present - wanted)))


def _joined(names: Column) -> Column:
    return F.array_join(F.array_sort(names), ",")


def missing_names(present: Column, required: Sequence[str]) -> Column:
    """Required names absent from an array of names, sorted and comma-joined ('' if none)."""
    return _joined(F.array_except(F.array(*[F.lit(n) for n in required]), present))


def unexpected_names(present: Column, required: Sequence[str]) -> Column:
    return _joined(F.array_except(present, F.array(*[F.lit(n) for n in required])))


def header_names(header: Column) -> Column:
    """Column names of a sheet: trimmed and in upper case.

    A blank header cell is named by its position, and a text that occurs again gets a running
    number, as the usual table readers do, before names are trimmed. Names that become equal only
    then stay equal.

    Every row of a sheet has its header, so the common case has to be cheap: texts that differ, none of
    them blank, with no white space but plain blanks.
    """
    texts = F.transform(header, lambda h, i: F.coalesce(h, F.concat(F.lit("Unnamed: "), i)))
    before = lambda h, i: F.size(F.filter(F.slice(texts, F.lit(1), i), lambda x: x == h))
    numbered = lambda h, i: F.when(before(h, i) > 0, F.concat(h, F.lit("."), before(h, i))).otherwise(h)
    each = F.transform(F.transform(texts, numbered), lambda h: F.upper(strip(h)))
    odd = F.array_join(header, " ", _BLANK).rlike(NOT_PLAIN)
    plain = ~odd & (F.size(F.array_distinct(header)) == F.size(header))
    return F.when(plain, F.transform(header, lambda h: F.upper(F.trim(h)))).otherwise(each)


def once(df: DataFrame, found: Column) -> DataFrame:
    """The fields of a struct as further columns that every row computes once: no filter on them is moved in front of them."""
    return df.select("*", F.inline(F.array(found)))


def usual_header(header: Column, required: Sequence[str]) -> Column:
    """Whether a header is the required names in their order, in any case and between plain blanks.

    One pattern over the joined header decides it: as many cells as names and as many tabs between them, so no
    cell has a tab of its own, and a null leaves a mark that no name matches.
    """
    names = r" *\t *".join(re.escape(n) for n in required)
    joined = F.array_join(header, "\t", "\n")
    return (F.size(header) == len(required)) & joined.rlike(rf"(?i)\A *{names} *\z")


def with_contract(raw: DataFrame, required: Sequence[str], **further: Column) -> DataFrame:
    """Raw sheet rows with ``names``, the ``missing`` and ``unexpected`` ones, and ``repeated``, by their own header.

    ``in_order`` tells a sheet that begins with the required columns in their order, as most do:
    nothing has to be searched in it. A row without a header (an unreadable workbook or sheet) has nulls.
    Names of a usual header are known from the contract. ``further`` columns are computed once per row, too.
    """
    wanted = F.array(*[F.lit(c) for c in required])
    more = [c.alias(name) for name, c in further.items()]
    known = F.struct(wanted.alias("names"), F.lit(True).alias("_usual"), *more)
    read = F.struct(header_names(F.col("header")).alias("names"), F.lit(False).alias("_usual"), *more)
    judged = once(raw, F.when(usual_header(F.col("header"), required), known).otherwise(read))
    in_order = F.col("_usual") | (F.slice("names", F.lit(1), F.lit(len(required))) == wanted)
    same = F.col("_usual") | (F.col("names") == wanted)
    return judged.withColumns(
        {
            "in_order": in_order,
            "missing": F.when(in_order, "").otherwise(missing_names(F.col("names"), required)),
            "unexpected": F.when(same, "").otherwise(unexpected_names(F.col("names"), required)),
            "repeated": ~same & (F.size(F.array_distinct("names")) < F.size("header")),
        }
    ).drop("_usual")


def cell(name: str | Column, place: int | None = None) -> Column:
    """Cell of a named column in a raw row; null where the row is shorter or has no such column.

    ``place`` is the column's own in a sheet that is in order.
    """
    found = F.get("cells", (F.array_position("names", name) - 1).cast("int"))
    return found if place is None else F.when(F.col("in_order"), F.get("cells", F.lit(place))).otherwise(found)


def contract_report(raw: DataFrame, required: Sequence[str], unit: Sequence[str] = ("path", "sheet")) -> DataFrame:
    """One row per unit of raw sheet rows: what its header lacks or has beyond the contract, and whether it is accepted.

    All rows of a unit share one header, so its report is part of the key of a plain count, which
    shrinks to about one row per unit before the shuffle. An unreadable unit has no header and is not
    accepted.
    """
    report = ["missing", "unexpected", "repeated", "error"]
    counted = with_contract(raw, required).groupBy(*unit, *report).agg(F.count(F.lit(1)).alias("n"))
    good = (F.col("missing") == "") & ~F.col("repeated") & F.col("error").isNull()
    return counted.groupBy(*unit).agg(
        F.sum("n").alias("row_count"),
        *[F.max(c).alias(c) for c in ("missing", "unexpected", "error")],
        F.coalesce(F.every(good), F.lit(False)).alias("accepted"),
    )


def reject_units(df: DataFrame, rejected: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Rows whose unit is not listed in ``rejected``; a null is a value like any other."""
    named = rejected.select(*[F.col(u).alias(f"_rejected_{u}") for u in unit])
    return df.join(named, [F.col(u).eqNullSafe(F.col(f"_rejected_{u}")) for u in unit], "left_anti")
