"""Minimal workbooks for the tests."""

import zipfile
from xml.sax.saxutils import escape

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_REL = "http://schemas.openxmlformats.org/package/2006/relationships"


class Date(float):
    """A serial number that is shown as a date."""


def _column(i):
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(ref, value, strings, inline):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, Date):
        return f'<c r="{ref}" s="1"><v>{float(value)}</v></c>'
    if isinstance(value, int | float):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if inline:
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    strings.append(value)
    return f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>'


def write_workbook(path, sheets, inline=False, cut=0):
    """``sheets``: name to rows of cell values; ``cut`` characters are lost at each sheet's end."""
    strings = []
    with zipfile.ZipFile(path, "w") as z:
        for n, rows in enumerate(sheets.values(), start=1):
            body = "".join(
                f'<row r="{r}">'
                + "".join(_cell(f"{_column(i)}{r}", v, strings, inline) for i, v in enumerate(row))
                + "</row>"
                for r, row in enumerate(rows, start=1)
            )
            z.writestr(
                f"xl/worksheets/sheet{n}.xml",
                f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>"[: -cut or None],
            )
        items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
        z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{items}</sst>")
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet {MAIN}><numFmts count="1"><numFmt numFmtId="165" formatCode="dd/mm/yyyy"/>'
            '</numFmts><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        )
        names = "".join(
            f'<sheet name="{s}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, start=1)
        )
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        links = "".join(
            f'<Relationship Id="rId{n}" Type="{REL}/worksheet" Target="worksheets/sheet{n}.xml"/>'
            for n in range(1, len(sheets) + 1)
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{PACKAGE_REL}">{links}</Relationships>',
        )
