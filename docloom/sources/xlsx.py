"""A workbook of any size as a sink: tasks write compressed parts of sheets, the commit puts them behind one another.

A row's XML is a column expression, so tasks only compress text. A part is a raw deflate stream that ends on a byte
without closing; parts in order, and an empty closing block, are one valid stream, whose checksum follows from the parts'
checksums. The driver thus copies compressed bytes and sees no row. Sheets that would hold more rows than the format allows go
on in further ones.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from xml.sax.saxutils import escape

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import NumericType, StructType

from docloom.sources.writers import BODY, CENTERED, FILLS, _row, _styles, _tools

# The format's limit of rows a sheet, its namespaces and the characters that XML can't hold.
MOST_ROWS = 1_048_576
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
NO_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"
#: A part is closed at so many rows, so that sheets can be cut between parts.
PART_ROWS = 65_536


def shown_columns(sheet: DataFrame) -> list[str]:
    """The columns that are written; `<name>_fill` beside `<name>` only colours."""
    return [c for c in sheet.columns if not (c.endswith("_fill") and c.removesuffix("_fill") in sheet.columns)]


def row_xml(sheet: DataFrame, centered: Sequence[str] = ()) -> Column:
    """A row's XML: finite numbers as such, anything else as text without characters that XML can't hold, nulls as empty cells."""
    cells = []
    for field in sheet.select(*[F.col(f"`{c}`") for c in shown_columns(sheet)]).schema:
        value, fill = F.col(f"`{field.name}`"), f"{field.name}_fill"
        move, bare = (CENTERED, CENTERED) if field.name in centered else (0, BODY)
        style = F.lit(f' s="{bare}"')
        if fill in sheet.columns:
            filled = F.create_map(*[F.lit(x) for k, name in enumerate(FILLS, 1) for x in (name, f' s="{k + move}"')])
            style = F.coalesce(filled[F.col(f"`{fill}`")], style)
        text = value.cast("string")
        for mark, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(mark), F.lit(code))
        text = F.concat(F.lit(' t="inlineStr"><is><t xml:space="preserve">'), F.regexp_replace(text, NO_XML, ""), F.lit("</t></is></c>"))
        if isinstance(field.dataType, NumericType):
            finite = F.abs(value.cast("double")) < float("inf")
            text = F.when(finite, F.concat(F.lit("><v>"), value.cast("string"), F.lit("</v></c>"))).otherwise(text)
        cells.append(F.concat(F.lit("<c"), style, F.coalesce(text, F.lit("/>"))))
    return F.concat(F.lit("<row>"), *cells, F.lit("</row>"))


def _times(matrix: Sequence[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector, k = vector >> 1, k + 1
    return out


def joined_crc(first: int, second: int, length: int) -> int:
    """The checksum of two byte strings behind one another, from theirs and the second's length: `first` is moved on by that many zero bytes."""
    matrix = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit
    for _ in range(3):
        matrix = [_times(matrix, row) for row in matrix]  # doubled: one zero byte
    while length:
        if length & 1:
            first = _times(matrix, first)
        matrix = [_times(matrix, row) for row in matrix]
        length >>= 1
    return first ^ second


@dataclass
class Part(WriterCommitMessage):
    """What a task has written: (sheet, rows, bytes before compression, checksum, file) per part, in the order of its rows."""

    partition: int
    parts: list[tuple[int, int, int, int, str]]


class Deflated:
    """A part's open stream."""

    def __init__(self, target: object):
        self.target, self.packer = target, zlib.compressobj(6, zlib.DEFLATED, -15)
        self.rows = self.size = self.crc = 0

    def add(self, xml: bytes, rows: int = 0) -> None:
        self.rows, self.size, self.crc = self.rows + rows, self.size + len(xml), zlib.crc32(xml, self.crc)
        self.target.write(self.packer.compress(xml))

    def close(self) -> None:
        self.target.write(self.packer.flush(zlib.Z_FULL_FLUSH))
        self.target.close()


class XlsxWriter(DataSourceWriter):
    """Rows (sheet int, xml string), sheet after sheet in each partition."""

    def __init__(self, path: str, book: dict):
        self.path, self.book = path, book
        self.folder = f"{path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Part:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, folder = fs.FileSystem.from_uri(self.folder)
        files.create_dir(folder, recursive=True)
        done: list[tuple[int, int, int, int, str]] = []
        sheet, part, name = None, None, ""
        for row in iterator:
            if part is None or row.sheet != sheet or part.rows >= PART_ROWS:
                if part is not None:
                    part.close()
                    done.append((sheet, part.rows, part.size, part.crc, name))
                sheet, name = row.sheet, f"{context.partitionId()}-{context.taskAttemptId()}-{len(done)}"
                part = Deflated(files.open_output_stream(f"{folder}/{name}"))
            part.add(row.xml.encode(), 1)
        if part is not None:
            part.close()
            done.append((sheet, part.rows, part.size, part.crc, name))
        return Part(context.partitionId(), done)

    def commit(self, messages: list[Part | None]) -> None:
        parts = [p for m in sorted((m for m in messages if m), key=lambda m: m.partition) for p in m.parts]
        files, folder = fs.FileSystem.from_uri(self.folder)
        target = fs.FileSystem.from_uri(self.path)[1]
        sheets: list[tuple[str, int, list]] = []  # name, place in the book, its parts
        for number, name in enumerate(self.book["names"]):
            pages: list[list] = [[]]
            for p in (p for p in parts if p[0] == number):
                if pages[-1] and sum(x[1] for x in pages[-1]) + p[1] > self.book["most_rows"]:
                    pages.append([])
                pages[-1].append(p)
            sheets += [(name if k == 1 else f"{name[:24]} ({k})", number, page) for k, page in enumerate(pages, 1)]
        with files.open_output_stream(f"{folder}/book") as out:
            book = Archive(out)
            for entry, text in package([name for name, *_ in sheets]):
                book.add(entry, text)
            for k, (_, number, page) in enumerate(sheets, 1):
                before, after = self._around(number, sum(p[1] for p in page))
                book.joined(f"xl/worksheets/sheet{k}.xml", before, [(f"{folder}/{p[4]}", *p[2:4]) for p in page], after, files)
            book.close()
        files.move(f"{folder}/book", target)
        self._clear()

    def _around(self, number: int, n_rows: int) -> tuple[str, str]:
        """A sheet's XML in front of its rows and behind them."""
        columns, widths = self.book["columns"][number], self.book["widths"].get(self.book["names"][number], {})
        wide = "".join(f'<col min="{k}" max="{k}" width="{widths[c]}" customWidth="1"/>' for k, c in enumerate(columns, 1) if widths.get(c) is not None)
        view = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
        head = f'<worksheet xmlns="{MAIN}">{view}{f"<cols>{wide}</cols>" if wide else ""}<sheetData>{_row(columns, ["header"] * len(columns))}'
        return head, f"</sheetData>{_tools(columns, n_rows, self.book['choices'])}</worksheet>"

    def abort(self, messages: list[Part | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, folder = fs.FileSystem.from_uri(self.folder)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


def package(names: Sequence[str]) -> Iterator[tuple[str, str]]:
    """The workbook's own files: which sheets there are and how cells look."""
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(1, len(names) + 1))
    yield "[Content_Types].xml", (
        f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>'
    )
    yield "_rels/.rels", f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="r1" Type="{RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    listed = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names, 1))
    yield "xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{listed}</sheets></workbook>'
    links = "".join(f'<Relationship Id="r{k}" Type="{RELATIONS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
    yield "xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{links}<Relationship Id="s1" Type="{RELATIONS}/styles" Target="styles.xml"/></Relationships>'
    yield "xl/styles.xml", _styles(MAIN)


class Archive:
    """A zip file written front to back, with sizes of 64 bits, whose members may be made of compressed parts."""

    def __init__(self, out: object):
        self.out, self.at, self.members = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, text: str) -> None:
        self.joined(name, text, [], "", None)

    def joined(self, name: str, before: str, parts: Sequence[tuple[str, int, int]], after: str, files: fs.FileSystem | None) -> None:
        """A member of text, parts (file, size, checksum) and text; what they come to stands behind it."""
        start, crc, size, packed = self.at, 0, 0, 0
        self._write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 8, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name.encode()), 20) + name.encode() + struct.pack("<HHQQ", 1, 16, 0, 0))
        begun = self.at
        for text in (before, None, after):
            if text is None:
                for file, length, own in parts:
                    with files.open_input_stream(file) as source:
                        while block := source.read(1 << 20):
                            self._write(block)
                    crc, size = joined_crc(crc, own, length), size + length
            elif text:
                raw, packer = text.encode(), zlib.compressobj(6, zlib.DEFLATED, -15)
                self._write(packer.compress(raw) + packer.flush(zlib.Z_FULL_FLUSH))
                crc, size = joined_crc(crc, zlib.crc32(raw), len(raw)), size + len(raw)
        self._write(b"\x03\x00")  # an empty block that closes the stream
        packed = self.at - begun
        self._write(struct.pack("<IIQQ", 0x08074B50, crc, packed, size))
        self.members.append((name.encode(), crc, packed, size, start))

    def close(self) -> None:
        start = self.at
        for name, crc, packed, size, at in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, packed, at)
            self._write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 8, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra)
        size, end, n = self.at - start, self.at, len(self.members)
        self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, start) + struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), 0xFFFFFFFF, 0xFFFFFFFF, 0))


class XlsxSource(DataSource):
    """Format docloom_xlsx: writes rows (sheet, xml) as a workbook; see write_workbook()."""

    @classmethod
    def name(cls) -> str:
        return "docloom_xlsx"

    def schema(self) -> str:
        return "sheet int, xml string"

    def writer(self, schema: StructType, overwrite: bool) -> XlsxWriter:
        return XlsxWriter(self.options["path"], json.loads(self.options["book"]))


def write_workbook(
    sheets: dict[str, DataFrame], path: str, *, widths: Mapping[str, Mapping[str, float]] | None = None, choices: Mapping[str, Sequence[str]] | None = None, centered: Sequence[str] = (), most_rows: int = MOST_ROWS - 1,
) -> None:
    """Writes the sheets as one xlsx file at `path`, a URI that driver and executors can reach; rows keep their sheet's order.

    Header row first, frozen and with a filter. A column `<name>_fill` beside `<name>` isn't written: its value, of
    FILLS, colours that cell. `widths` has each sheet's column widths, `choices` the values that a column's cells offer
    as a list; columns named `centered` are centred. Cells have thin borders and wrap. A sheet of more rows than `most_rows` goes on in sheets `<name> (2)` and so on. A file at `path` is replaced, once the whole book is written.
    """
    first = next(iter(sheets.values()))
    spark = first.sparkSession
    spark.dataSource.register(XlsxSource)
    book = {
        "names": list(sheets), "columns": [shown_columns(s) for s in sheets.values()], "widths": {k: dict(v) for k, v in (widths or {}).items()},
        "choices": {k: list(v) for k, v in (choices or {}).items()}, "most_rows": max(most_rows, PART_ROWS),
    }
    rows = reduce(DataFrame.unionByName, [s.select(F.lit(k).alias("sheet"), row_xml(s, centered).alias("xml")) for k, s in enumerate(sheets.values())])
    rows.write.format("docloom_xlsx").option("path", path if "://" in path else f"file://{path}").option("book", json.dumps(book)).mode("append").save()
