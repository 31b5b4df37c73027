"""Small hand-made inputs."""

import io
import zipfile

from pyspark.sql import types as T

from hazardlens.schemas import PHYSICAL_LONG, SIDECAR_FIELDS, TRANSITION_LONG

PHYSICAL = {"source_file": "p", "assetName": "a", "scenario": "s", "timeHorizon": "2030", "hazard": "Flood"}
TRANSITION = {"source_file": "t", "assetName": "a", "scenario": "s", "timeHorizon": "2030", "subrisk": "X"}


def _rows(spark, schema, base, rows):
    names = [f.name for f in schema.fields]
    unknown = {k for row in rows for k in row} - set(names)
    assert not unknown, unknown
    data = [tuple({"seq": i, **base, **row}.get(n) for n in names) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def physical(spark, *rows):
    return _rows(spark, PHYSICAL_LONG, PHYSICAL, rows)


def transition(spark, *rows):
    return _rows(spark, TRANSITION_LONG, TRANSITION, rows)


def sidecar(spark, *rows):
    schema = T.StructType(
        [T.StructField("seq", T.LongType())] + [T.StructField(f, T.StringType()) for f in SIDECAR_FIELDS]
    )
    return spark.createDataFrame(
        [tuple({"seq": i, **dict.fromkeys(SIDECAR_FIELDS, ""), **row}[f.name] for f in schema) for i, row in enumerate(rows)],
        schema,
    )


def text_frame(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def values(df, *cols):
    """Collected rows as plain tuples, sorted so that order cannot matter."""
    rows = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def column(df, col):
    return [r[0] for r in df.select(col).collect()]


def workbook(sheets: dict[str, str], shared=()) -> bytes:
    """A workbook from the XML of its sheets' rows."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>',
        )
        if shared:
            items = "".join(f"<si><t>{s}</t></si>" for s in shared)
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
        for i, rows in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


def sheet(rows) -> str:
    """Rows of text or numbers as inline cells; None leaves the cell out."""
    out = []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, value in enumerate(row):
            ref = f"{_letters(c)}{r}"
            if isinstance(value, str):
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>')
            elif value is not None:
                cells.append(f'<c r="{ref}"><v>{value}</v></c>')
        out.append(f'<row r="{r}">{"".join(cells)}</row>')
    return "".join(out)


def _letters(index: int) -> str:
    index, out = index + 1, ""
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out
