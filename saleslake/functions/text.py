"""Text clean-up and names taken from paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip() removes.
WHITESPACE = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)
# Characters outside of two ranges of plain letters, signs and the blank, which hold no other white space.
NOT_PLAIN = r"[^\u0020-\u007e\u00a1-\u024f]"
# Fixed value: what a workbook's name has in front of the branch.
BRANCH_PREFIX = r"(?i)ventas[_\s-]*"
# Fixed value: directory layout of one branch-month.
UNIT_PATH = r"sucursal=([^/]+)/year=(\d+)/month=(\d+)/"


def strip(c: Column) -> Column:
    """Trim all whitespace on both ends (plain ``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def text_or(c: Column, null_text: str) -> Column:
    """Column as text with a fixed text for missing values."""
    return F.coalesce(c.cast("string"), F.lit(null_text))


def branch_from_path(path: Column) -> Column:
    """Branch name of a workbook: file stem without every "ventas" prefix and without blanks."""
    file_name = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")
    return F.replace(F.regexp_replace(stem, BRANCH_PREFIX, ""), F.lit(" "), F.lit(""))


def _decoded(c: Column) -> Column:
    """Percent-encoded text decoded; unlike in forms a plus sign stays one."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def partition_values(path: Column) -> tuple[Column, Column, Column]:
    """(sucursal, year, month) of a branch-month path; null where the path has another shape.

    The path is a URI, as in ``_metadata.file_path``, and the writer escapes some characters of
    a partition's name itself: both are undone.
    """
    matched = path.rlike(UNIT_PATH)
    branch, year, month = (F.regexp_extract(path, UNIT_PATH, i) for i in (1, 2, 3))
    return (
        F.when(matched, _decoded(_decoded(branch))),
        F.when(matched, year).try_cast("int"),
        F.when(matched, month).try_cast("int"),
    )
