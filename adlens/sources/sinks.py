"""Sinks: spreadsheet, crops, reports."""

from __future__ import annotations

import struct
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from typing import IO
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame


def _cell(ref: str, value: object, style: int) -> str:
    if value is None or value == "":
        return f'<c r="{ref}" s="{style}"/>'
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        text = "".join(c for c in str(value) if c in "\t\n\r" or c >= " ")[:32767]
        return f'<c r="{ref}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f'<c r="{ref}" s="{style}"><v>{value!r}</v></c>'


def _column(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


_STYLES = (
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="2"><font/><font><b/></font></fonts>'
    '<fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="2"><xf applyAlignment="1"><alignment vertical="center" wrapText="1"/></xf>'
    '<xf fontId="1" applyFont="1" applyAlignment="1"><alignment horizontal="center"/></xf></cellXfs></styleSheet>'
)


PACKAGE = "http://schemas.openxmlformats.org/package/2006"
#: Fixed values of the format: rows of a sheet below its header.
ROWS = 1_048_575
#: Pixels that a picture may take.
BOX_W, BOX_H = 440, 200


class Workbook:
    """Minimal spreadsheet writer: sheets stream row by row into the archive."""

    def __init__(self, path: str):
        self.zip = zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED)
        self.sheets: list[str] = []
        self.drawings: list[int] = []

    def sheet(self, title: str, header: list[tuple[str, int]], rows: Iterable[tuple], link: int | None = None, picture: int | None = None) -> int:
        """Rows of a sheet, at most ROWS; `link` is the column of addresses, `picture` one of PNG files shown over the first column."""
        self.sheets.append(title[:31])
        n, links = 0, []
        spool, placed = tempfile.TemporaryFile(), []  # the archive takes one entry at a time
        last = _column(len(header) - 1)
        with self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True) as f:
            put = lambda s: f.write(s.encode("utf-8"))
            put('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">')
            put('<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>')
            put("".join(f'<col min="{i + 1}" max="{i + 1}" width="{w}" customWidth="1"/>' for i, (_, w) in enumerate(header)))
            put('</cols><sheetData><row r="1">' + "".join(_cell(f"{_column(i)}1", name, 1) for i, (name, _) in enumerate(header)) + "</row>")
            for row in rows:
                n += 1
                if link is not None and row[link]:
                    links.append((f"{_column(link)}{n + 1}", str(row[link])))
                tall = ""
                if picture is not None:
                    row = list(row)
                    data = row.pop(picture)
                    if data:
                        placed.append((n, spool.tell(), len(data), *struct.unpack(">II", bytes(data[16:24]))))
                        spool.write(data)
                        tall = f' ht="{BOX_H * 0.75 + 4:g}" customHeight="1"'
                put(f'<row r="{n + 1}"{tall}>' + "".join(_cell(f"{_column(i)}{n + 1}", v, 0) for i, v in enumerate(row)) + "</row>")
            put(f'</sheetData><autoFilter ref="A1:{last}{max(2, n + 1)}"/>')
            if links:
                put("<hyperlinks>" + "".join(f'<hyperlink ref="{r}" r:id="rId{i}"/>' for i, (r, _) in enumerate(links, 1)) + "</hyperlinks>")
            if placed:
                put('<drawing r:id="rIdPictures"/>')
            put("</worksheet>")
        base, page = "http://schemas.openxmlformats.org/officeDocument/2006/relationships", len(self.sheets)
        rels = "".join(f'<Relationship Id="rId{i}" Type="{base}/hyperlink" Target={quoteattr(u)} TargetMode="External"/>' for i, (_, u) in enumerate(links, 1))
        if placed:
            rels += f'<Relationship Id="rIdPictures" Type="{base}/drawing" Target="../drawings/drawing{page}.xml"/>'
            self._pictures(page, spool, placed)
        if rels:
            self.zip.writestr(f"xl/worksheets/_rels/sheet{page}.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{rels}</Relationships>')
        spool.close()
        return n

    def _pictures(self, page: int, spool: IO[bytes], placed: list[tuple[int, int, int, int, int]]) -> None:
        """Pictures of a sheet, each in the first cell of its row, made smaller to fit but never larger."""
        main, draw = "http://schemas.openxmlformats.org/drawingml/2006", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        self.drawings.append(page)
        anchors, rels = [], []
        for k, (row, at, size, w, h) in enumerate(placed, 1):
            scale = min(BOX_W / w, BOX_H / h, 1.0)
            spool.seek(at)
            self.zip.writestr(f"xl/media/p{page}_{k}.png", spool.read(size), zipfile.ZIP_STORED)
            rels.append(f'<Relationship Id="rId{k}" Type="{draw}/image" Target="../media/p{page}_{k}.png"/>')
            extent = f'cx="{int(w * scale * 9525)}" cy="{int(h * scale * 9525)}"'
            anchors.append(
                f'<xdr:oneCellAnchor><xdr:from><xdr:col>0</xdr:col><xdr:colOff>0</xdr:colOff><xdr:row>{row}</xdr:row><xdr:rowOff>0</xdr:rowOff></xdr:from><xdr:ext {extent}/>'
                f'<xdr:pic><xdr:nvPicPr><xdr:cNvPr id="{k}" name="p{k}"/><xdr:cNvPicPr/></xdr:nvPicPr><xdr:blipFill><a:blip r:embed="rId{k}"/><a:stretch><a:fillRect/></a:stretch></xdr:blipFill>'
                f'<xdr:spPr><a:xfrm><a:off x="0" y="0"/><a:ext {extent}/></a:xfrm><a:prstGeom prst="rect"><a:avLst/></a:prstGeom></xdr:spPr></xdr:pic><xdr:clientData/></xdr:oneCellAnchor>'
            )
        self.zip.writestr(f"xl/drawings/drawing{page}.xml", f'<xdr:wsDr xmlns:xdr="{main}/spreadsheetDrawing" xmlns:a="{main}/main" xmlns:r="{draw}">' + "".join(anchors) + "</xdr:wsDr>")
        self.zip.writestr(f"xl/drawings/_rels/drawing{page}.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{"".join(rels)}</Relationships>')

    def close(self) -> None:
        pkg, doc = PACKAGE, "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        k = range(1, len(self.sheets) + 1)
        self.zip.writestr("[Content_Types].xml", f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Default Extension="png" ContentType="image/png"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{main}.styles+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i in k) + "".join(f'<Override PartName="/xl/drawings/drawing{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.drawing+xml"/>' for i in self.drawings) + "</Types>")
        self.zip.writestr("_rels/.rels", f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{doc}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self.zip.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{pkg}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{doc}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in k) + f'<Relationship Id="rId{len(self.sheets) + 1}" Type="{doc}/styles" Target="styles.xml"/></Relationships>')
        self.zip.writestr("xl/styles.xml", _STYLES)
        names = "".join(f'<sheet name={quoteattr(t)} sheetId="{i}" r:id="rId{i}"/>' for i, t in enumerate(self.sheets, 1))
        self.zip.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{doc}"><sheets>{names}</sheets></workbook>')
        self.zip.close()


def write_sheets(path: str, sheets: list[tuple[str, DataFrame]], widths: dict[str, int] | None = None, link: str | None = None, picture: str | None = None) -> list[int]:
    """Rows of each table in a sheet of its own; rows stream through the driver one partition at a time.

    A table with more rows than a sheet holds goes on in further sheets. `picture` is a
    column of PNG files, shown in the first cell of their rows.
    """
    book = Workbook(path)
    counts = []
    for title, df in sheets:
        shown = [c for c in df.columns if c != picture]
        header = [(c, (widths or {}).get(c, 18)) for c in shown]
        at = shown.index(link) if link in shown else None
        rows = df.select(*shown, *([picture] if picture in df.columns else []))
        image = len(shown) if picture in df.columns else None
        stream, total, part = (tuple(r) for r in rows.toLocalIterator()), 0, 0
        while True:
            part += 1
            n = book.sheet(title if part == 1 else f"{title[:25]} ({part})", header, islice(stream, ROWS), at, image)
            total += n
            ahead = next(stream, None) if n == ROWS else None
            if ahead is None:
                break
            stream = chain([ahead], stream)
        counts.append(total)
    book.close()
    return counts


def write_files(rows: DataFrame, folder: str, name: str = "name", data: str = "data") -> DataFrame:
    """Writes accepted rows' bytes as files of a shared folder, from the executors; (name, bytes).

    Names must be unique; a task that runs again writes the same files again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.makedirs(folder, exist_ok=True)
        for df in batches:
            sizes = []
            for n, d in zip(df[name], df[data]):
                part = os.path.join(folder, f".{os.getpid()}.{n}")
                with open(part, "wb") as f:
                    f.write(d)
                os.replace(part, os.path.join(folder, n))
                sizes.append(len(d))
            yield pd.DataFrame({"name": df[name], "bytes": sizes})

    return rows.select(name, data).mapInPandas(run, "name string, bytes long")


def report(df: DataFrame, limit: int = 100) -> str:
    """Text table of the first rows, for a terminal."""
    return df.limit(limit).toPandas().to_string(index=False)
