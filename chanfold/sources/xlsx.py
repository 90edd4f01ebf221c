"""Spreadsheet (xlsx) source as a Spark job.

No Excel library is installed, and Spark has no spreadsheet reader, so the
workbook format is handled with the standard library inside tasks:
``binaryFile`` distributes the workbooks (one record per file, so the work
spreads over files), ``mapInPandas`` parses the first sheet of each and emits
rows in Arrow batches under a declared schema.

An xlsx file is a zip of XML parts: ``xl/workbook.xml`` lists the sheets,
``xl/_rels/workbook.xml.rels`` maps them to part names, ``xl/sharedStrings.xml``
holds deduplicated strings and each sheet stores cells as ``<c r="B2" t=..>``.
"""

from __future__ import annotations

import html
import io
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructType, _parse_datatype_string)

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
BATCH_ROWS = 10_000


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_part(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find("m:sheets/m:sheet", NS)
    rid = sheet.get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", NS):
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise ValueError("workbook has no first sheet")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t"))
            for si in root.findall("m:si", NS)]


_ROW = re.compile(rb"<(?:\w+:)?row\b[^>]*?(?:/>|>(.*?)</(?:\w+:)?row>)", re.S)
_CELL = re.compile(rb"<(?:\w+:)?c\b([^>]*?)(?:/>|>(.*?)</(?:\w+:)?c>)", re.S)
_REF = re.compile(rb'\br="([A-Z]+)')
_TYPE = re.compile(rb'\bt="(\w+)"')
_V = re.compile(rb"<(?:\w+:)?v>(.*?)</(?:\w+:)?v>", re.S)
_T = re.compile(rb"<(?:\w+:)?t(?:\s[^>]*)?>(.*?)</(?:\w+:)?t>", re.S)
#: A cell as most writers put it: 4 tags around a value, 6 around inline text.
_PLAIN = re.compile(r'<c r="([A-Z]+)[0-9]+"(?: t="inlineStr"><is><t>([^<]*)</t></is>'
                    r'|(?: t="(s|str|e|b|n)")?><v>([^<]+)</v>)</c>')


def _plain_row(body: bytes, col_of: dict[str, int], strings: list[str]) -> dict | None:
    """The row, or None if there is anything but plain cells in it."""
    text = body.decode("utf-8")
    cells = _PLAIN.findall(text)
    if text.count("<") != sum(4 if v else 6 for _, _, _, v in cells):
        return None
    row, escaped = {}, "&" in text
    for letters, inline, kind, v in cells:
        idx = col_of.get(letters)
        if idx is None:
            idx = col_of[letters] = _col_index(letters)
        if not v:
            row[idx] = html.unescape(inline) if escaped else inline
        elif kind == "s":
            row[idx] = strings[int(v)]
        elif kind in ("str", "e"):
            row[idx] = html.unescape(v) if escaped else v
        elif kind == "b":
            row[idx] = v.strip() == "1"
        else:
            row[idx] = float(v)
    return row


def _text(raw: bytes) -> str:
    text = raw.decode("utf-8")
    return html.unescape(text) if "&" in text else text


def iter_sheet_rows(content: bytes):
    """Yield each row of the first sheet as a dict column index -> raw value
    (str for text cells, float for numbers, bool for booleans).

    The sheet part is scanned with compiled patterns over the raw XML rather
    than built into a tree: cells are flat, and this is several times faster
    in a Python worker; rows of plain cells take one pattern for all of them."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = _shared_strings(z)
        xml = z.read(_first_sheet_part(z))
    col_of: dict[bytes, int] = {}
    plain_col_of: dict[str, int] = {}
    for rm in _ROW.finditer(xml):
        body = rm.group(1) or b""
        row = _plain_row(body, plain_col_of, strings)
        if row is not None:
            yield row
            continue
        row = {}
        for attrs, inner in _CELL.findall(body):
            ref = _REF.search(attrs)
            if ref is None:
                idx = len(row)
            else:
                letters = ref.group(1)
                idx = col_of.get(letters)
                if idx is None:
                    idx = col_of[letters] = _col_index(letters.decode())
            tm = _TYPE.search(attrs)
            t = tm.group(1) if tm else b"n"
            if t == b"inlineStr":
                row[idx] = "".join(_text(x) for x in _T.findall(inner))
                continue
            v = _V.search(inner)
            if v is None:
                continue
            raw = v.group(1)
            if t == b"s":
                row[idx] = strings[int(raw)]
            elif t in (b"str", b"e"):
                row[idx] = _text(raw)
            elif t == b"b":
                row[idx] = raw.strip() == b"1"
            else:
                row[idx] = float(raw)
        yield row


def _to_text(v):
    if isinstance(v, float) and v.is_integer():
        return str(int(v))          # numbers typed as text keep no trailing ".0"
    return str(v)


def _to_int(v):
    number = float(v)
    if not number.is_integer():
        raise ValueError(f"{v!r} is not a whole number")
    return int(number)


_BOOLEANS = {"true": True, "1": True, "false": False, "0": False}


def _to_bool(v):
    if isinstance(v, bool):
        return v
    text = _to_text(v).strip().lower()
    if text not in _BOOLEANS:
        raise ValueError(f"{v!r} is not a boolean")
    return _BOOLEANS[text]


def _converter(dtype):
    """Raw cell value -> the declared type (None stays None).  A value that is
    not of that type, or a type that cells do not have, is an error."""
    kinds = {StringType: _to_text, LongType: _to_int, IntegerType: _to_int, DoubleType: float,
             BooleanType: _to_bool}
    fn = kinds.get(type(dtype))
    if fn is None:
        raise TypeError(f"spreadsheet cells cannot be read as {dtype.simpleString()}")
    return lambda v: None if v is None else fn(v)


def parse_workbooks(schema: StructType):
    """``mapInPandas`` function: (content) batches -> typed rows.  The header
    row names the columns; declared columns absent from a workbook are null;
    undeclared columns are dropped."""
    fields = schema.fields
    names = [f.name for f in fields]
    convs = [_converter(f.dataType) for f in fields]

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = iter_sheet_rows(bytes(content))
                header = next(rows, None)
                if header is None:
                    continue
                pos = {str(v): i for i, v in header.items()}
                plan = [(pos.get(n, -1), c) for n, c in zip(names, convs)]
                buf = []
                for r in rows:
                    buf.append([c(r.get(i)) for i, c in plan])
                    if len(buf) >= BATCH_ROWS:
                        yield pd.DataFrame(buf, columns=names)
                        buf = []
                if buf:
                    yield pd.DataFrame(buf, columns=names)
    return run


def read_xlsx(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Read every ``*.xlsx`` under ``path`` (a file or a folder of workbooks)."""
    from chanfold.session import ship_package
    ship_package(spark)
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
             .load(path).select("content"))
    return files.mapInPandas(parse_workbooks(schema), schema)


# ---------------------------------------------------------------- writer
# Needed to produce spreadsheet inputs from the driver tables; each task
# writes one workbook per partition into a folder reachable as a POSIX path.

def _esc(text: str) -> str:
    return (text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
                .replace('"', "&quot;"))


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def workbook_bytes(columns: list[str], rows) -> bytes:
    """Minimal single-sheet workbook with inline strings."""
    def cell(ref, v):
        if v is None or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{repr(float(v)) if isinstance(v, float) else v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{_esc(str(v))}</t></is></c>'

    out = io.StringIO()
    out.write('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
              f'<worksheet xmlns="{NS["m"]}"><sheetData>')
    for r, values in enumerate([columns] + list(rows), 1):
        out.write(f'<row r="{r}">')
        out.write("".join(cell(f"{_col_letters(i)}{r}", v) for i, v in enumerate(values)))
        out.write("</row>")
    out.write("</sheetData></worksheet>")
    parts = {
        "[Content_Types].xml":
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            '</Types>',
        "_rels/.rels":
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{NS["rel"]}"><Relationship Id="rId1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
            'Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml":
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
            '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels":
            '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            f'<Relationships xmlns="{NS["rel"]}"><Relationship Id="rId1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
            'Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": out.getvalue(),
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()


def write_xlsx(df: DataFrame, folder: str, rows_per_file: int = 25_000) -> int:
    """Write the partitions of ``df`` as workbooks of at most ``rows_per_file``
    rows into ``folder`` (a POSIX path shared by all executors).  Returns the
    number of workbooks.

    The file name is the partition number and the workbook's number in it, and
    each file is written under a temporary name and renamed into place, so a
    retried or speculative task replaces its own workbooks instead of adding
    others."""
    import os
    import uuid
    from chanfold.session import ship_package
    ship_package(df.sparkSession)
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local, exist_ok=True)
    columns = df.columns

    def write(rows, number):
        from pyspark import TaskContext
        name = f"part-{TaskContext.get().partitionId():05d}-{number:05d}.xlsx"
        tmp = os.path.join(local, f".{name}.{uuid.uuid4().hex}.tmp")
        with open(tmp, "wb") as fh:
            fh.write(workbook_bytes(columns, rows))
        os.replace(tmp, os.path.join(local, name))
        return pd.DataFrame({"file": [name], "rows": [len(rows)]})

    def run(batches):
        rows, number = [], 0
        for pdf in batches:
            rows.extend(pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None))
            while len(rows) >= rows_per_file:
                yield write(rows[:rows_per_file], number)
                rows, number = rows[rows_per_file:], number + 1
        if rows:
            yield write(rows, number)

    return df.mapInPandas(run, "file string, rows bigint").count()
