"""Bytes of a file to text, by format, with the standard library where it suffices.

An adapter is a function (path, content, options) -> (text, meta). It raises where a file is broken; callers turn that
into a row of errors. PDF layout, OCR and old Excel files need libraries that may be absent: they are used where they are
installed, and `hooks` takes others.
"""

from __future__ import annotations

import csv
import gzip
import importlib
import io
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from ..functions.json_harvest import harvest
from ..functions.text import IMAGE_SIGNAL, OCR_LANGUAGES, PDF_SIGNAL
from ..functions.text_udf import outline
from . import pdf
from .compound import MAGIC, doc_text, xls_rows

SEPARATOR = " | "


@dataclass
class Options:
    """What adapters can be told. hooks: 'pdf' (bytes -> list of pages of blocks (x0, y0, text)), 'pdf_ocr' and 'image_ocr'
    ((bytes, options) -> text); without them pdf_ocr() and image_ocr() below are tried. ocr: whether to try at all."""

    delimiter: str = ","
    sheet: int = 0
    ocr_languages: str = "spa+eng"
    ocr_dpi: int = 300
    ocr: bool = True
    gpu: bool = False
    hooks: dict[str, Callable] = field(default_factory=dict)


class Missing(RuntimeError):
    """A library or hook that a format needs is absent."""


def decoded(content: bytes) -> tuple[str, str]:
    """Text as UTF-8, else Latin-1, with line feeds only; the encoding's name."""
    try:
        text, name = content.decode("utf-8"), "utf-8"
    except UnicodeDecodeError:
        text, name = content.decode("latin-1"), "latin-1"
    return text.replace("\r\n", "\n").replace("\r", "\n"), name


def cells_text(names: list[str], values: list[str | None]) -> str:
    """'column: value | ...' of cells that aren't null, blank or nan."""
    return SEPARATOR.join(f"{k}: {v}" for k, v in zip(names, values, strict=True) if v is not None and v.strip() and v.lower() != "nan")


def text_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    text, encoding = decoded(content)
    return text, {"codificacion_detectada": encoding, "num_lineas": text.count("\n") + 1}


def csv_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """Rows with as many cells as the header, as text; others are counted and left out. Empty lines don't count at all."""
    text, encoding = decoded(content)
    rows = csv.reader(io.StringIO(text, newline=""), delimiter=options.delimiter)
    header = next(rows, [])
    last = {name: k for k, name in enumerate(header)}  # a repeated name keeps its last cell
    lines, omitted, valid = [], 0, 0
    for row in rows:
        if not row:
            continue
        if len(row) != len(header):
            omitted += 1
            continue
        valid += 1
        if line := cells_text([*last], [row[k] for k in last.values()]):
            lines.append(line)
    return "\n".join(lines), {"num_filas_validas": valid, "filas_omitidas_por_formato_invalido": omitted, "columnas": header, "codificacion_detectada": encoding}


#: What table readers take for an empty cell.
EMPTY_CELLS = frozenset([
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null"
])


def _tag(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2]


#: Formats of dates and times that workbooks need not spell out.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _dates(parts: zipfile.ZipFile) -> list[bool]:
    """For each style of a workbook's cells whether it shows a date."""
    if "xl/styles.xml" not in parts.namelist():
        return []
    every = [*ET.fromstring(parts.read("xl/styles.xml")).iter()]
    own = {int(e.get("numFmtId")): _QUOTED.sub("", e.get("formatCode", "")) for e in every if _tag(e) == "numFmt"}
    styles = next(([*e] for e in every if _tag(e) == "cellXfs"), [])
    kinds = [int(e.get("numFmtId", 0)) for e in styles]
    return [k in DATE_FORMATS if k not in own else bool(set("ymdhs") & set(own[k].lower())) for k in kinds]


def number_text(value: str, date: bool = False, from_1904: bool = False) -> str:
    """A number of a workbook as Python shows it; a date or a time of day as such."""
    try:
        x = float(value)
    except ValueError:
        return value
    if date and 0 <= x < 2_958_466:
        days, rest = divmod(round(x * 86_400_000), 86_400_000)
        if not from_1904 and days == 0 and rest:
            return str((datetime.min + timedelta(milliseconds=rest)).time())
        # there was no 29 February 1900, but workbooks count it
        first = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30 if days > 59 else 31)
        return str(first + timedelta(days, milliseconds=rest))
    return str(int(x)) if x.is_integer() and "." not in value and "e" not in value.lower() else repr(x)


def _column(reference: str) -> int:
    n = 0
    for c in reference:
        if c.isalpha():
            n = 26 * n + ord(c.upper()) - 64
    return n - 1


def sheet_rows(content: bytes, sheet: int = 0) -> list[list[str]]:
    """Cells of a workbook's sheet (Office Open XML) as strings, dates as dates."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        dates = _dates(z)
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for item in ET.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in item.iter() if _tag(t) == "t"))
        relations = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = [*ET.fromstring(z.read("xl/workbook.xml")).iter()]
        sheets = [s for s in book if _tag(s) == "sheet"]
        from_1904 = any(s.get("date1904") in ("1", "true") for s in book if _tag(s) == "workbookPr")
        target = relations[next(v for k, v in sheets[sheet].attrib.items() if k.endswith("}id"))]
        rows = []
        for row in ET.fromstring(z.read("xl/" + target.removeprefix("/xl/"))).iter():
            if _tag(row) != "row":
                continue
            cells: list[str] = []
            for cell in row:
                at = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                value = "".join(t.text or "" for t in cell.iter() if _tag(t) in ("v", "t"))
                if cell.get("t") == "s" and value:
                    value = shared[int(value)]
                elif cell.get("t") == "b":
                    value = "True" if value == "1" else "False"
                elif cell.get("t", "n") == "n" and value:
                    style = int(cell.get("s", 0))
                    value = number_text(value, style < len(dates) and dates[style], from_1904)
                cells += [""] * (at + 1 - len(cells))
                cells[at] = value
            rows.append(cells)
    return rows


def excel_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """The first sheet's rows as text, all cells as strings."""
    table = xls_rows(content, options.sheet) if content[:8] == MAGIC else sheet_rows(content, options.sheet)
    header, rows = (table[0], table[1:]) if table else ([], [])
    width = max([len(header), *map(len, rows)])
    header = [h or f"Unnamed: {k}" for k, h in enumerate(header + [""] * (width - len(header)))]
    rows = [["" if v in EMPTY_CELLS else v for v in r + [""] * (width - len(r))] for r in rows]
    lines = [line for r in rows if (line := cells_text(header, r))]
    return "\n".join(lines), {"num_filas": len(rows), "columnas": header}


def html_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    text, encoding = decoded(content)
    return outline(text), {"codificacion_detectada": encoding}


def json_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    got = harvest(content)
    if got["tier"] == 0:
        raise ValueError(got["error"])
    return got["texto"], {"tier": str(got["tier"]), **got["meta"]}


def page_text(blocks: list[tuple[float, float, str]]) -> str:
    """Blocks from top to bottom, then left to right, by tenths of a point."""
    ordered = sorted(blocks, key=lambda b: (round(b[1], 1), round(b[0], 1)))
    return "\n".join(t for b in ordered if (t := b[2].strip()))


def zoom_scale(dpi: int) -> float:
    """How much larger than its own 72 points an inch a page is rendered."""
    return dpi / 72


def _library(name: str):
    try:
        return importlib.import_module(name)
    except ImportError as why:
        raise Missing(f"no {name}") from why


#: EasyOCR's readers, one for each set of languages in a worker.
_readers: dict[tuple, object] = {}


def easyocr_languages(codes: str) -> list[str]:
    """'spa+eng' as ['es', 'en']; unknown codes stay, none at all means ['es']."""
    return [OCR_LANGUAGES.get(x, x) for part in codes.split("+") if (x := part.strip())] or ["es"]


def _easyocr(options: Options):
    easyocr = _library("easyocr")
    languages = easyocr_languages(options.ocr_languages)
    key = *languages, options.gpu
    if key not in _readers:
        _readers[key] = easyocr.Reader(languages, gpu=options.gpu)
    return lambda png: "\n\n".join(_readers[key].readtext(png, detail=0, paragraph=True))


def _page_reader(options: Options) -> Callable[[bytes], str]:
    """What reads a page's image: EasyOCR where it is installed, else Tesseract, whose words are joined by spaces."""
    try:
        return _easyocr(options)
    except Missing:
        image, tesseract = _library("PIL.Image"), _library("pytesseract")

    def read(png: bytes) -> str:
        words = tesseract.image_to_data(image.open(io.BytesIO(png)), lang=options.ocr_languages, output_type=tesseract.Output.DICT)["text"]
        return " ".join(w for w in words if w.strip())

    return read


def pdf_ocr(content: bytes, options: Options) -> str:
    """Pages rendered by PyMuPDF and read, by empty lines. A page that can't be read is empty; the others count."""
    fitz, read = _library("fitz"), _page_reader(options)
    scale = zoom_scale(options.ocr_dpi)
    pages = []
    with fitz.open(stream=content, filetype="pdf") as document:
        for page in document:
            try:
                pages.append(read(page.get_pixmap(matrix=fitz.Matrix(scale, scale)).tobytes("png")))
            except Exception:
                pages.append("")
    return "\n\n".join(pages)


def image_ocr(content: bytes, options: Options) -> str:
    """Paragraphs of an image by empty lines, with EasyOCR where it is installed, else Pillow and Tesseract."""
    try:
        read = _easyocr(options)
    except Missing:
        image, tesseract = _library("PIL.Image"), _library("pytesseract")
        return tesseract.image_to_string(image.open(io.BytesIO(content)), lang=options.ocr_languages)
    return read(content)


def _engine(name: str, own: Callable, options: Options) -> Callable:
    return options.hooks.get(name) or (own if options.ocr else lambda *_: "")


def pdf_pages(content: bytes, options: Options) -> list[list[tuple[float, float, str]]]:
    """Blocks (x0, y0, text) of each page: by the hook, PyMuPDF where it is installed, else the package's own reader."""
    if "pdf" in options.hooks:
        return options.hooks["pdf"](content)
    try:
        fitz = _library("fitz")
    except Missing:
        return pdf.blocks(content)
    with fitz.open(stream=content, filetype="pdf") as document:
        return [[(b[0], b[1], b[4]) for b in page.get_text("blocks")] for page in document]


def ocr_choice(text: str, read: str) -> bool:
    """Whether OCR's text takes the place of a file's own: there is next to none, and OCR gives more, white space apart."""
    return len(text.strip()) < PDF_SIGNAL and len(read.strip()) > len(text.strip())


def pdf_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """Pages in reading order; OCR where there is next to no text and OCR gives more. OCR that fails takes nothing away."""
    pages = pdf_pages(content, options)
    text, meta = "\n\n".join(map(page_text, pages)), {"num_paginas": len(pages)}
    if name := pdf.title(content):
        meta["titulo_pdf"] = name
    if len(text.strip()) < PDF_SIGNAL:
        try:
            read = _engine("pdf_ocr", pdf_ocr, options)(content, options) or ""
        except Missing:
            read = ""
        except Exception as why:
            read, meta = "", meta | {"ocr_error": f"{type(why).__name__}: {why}"}
        if ocr_choice(text, read):
            return read, meta | {"ocr_aplicado": True, "ocr_dpi": options.ocr_dpi, "ocr_idiomas": options.ocr_languages}
    return text, meta


def image_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """OCR's text if there is enough of it; any failure gives none."""
    try:
        text = _engine("image_ocr", image_ocr, options)(content, options)
    except Exception:
        text = ""
    return (text, {}) if len((text or "").strip()) >= IMAGE_SIGNAL else ("", {})


def docx_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """Paragraphs that aren't blank."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml"))
    lines = ["".join(t.text or "" for t in p.iter() if _tag(t) == "t") for p in body.iter() if _tag(p) == "p"]
    return "\n".join(x for x in lines if x.strip()), {}


# ---------------------------------------------------------------- vector tiles


def message_fields(data: bytes):
    """(field number, value) of a protocol buffer message: ints, or bytes."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size
        elif kind == 2:
            size = varint()
            if at + size > n:
                raise ValueError("a field is cut short")
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


def _value(data: bytes):
    for number, v in message_fields(data):
        if number == 1:
            return v.decode("utf-8")
        if number in (2, 3):
            return struct.unpack("<f" if number == 2 else "<d", v)[0]
        if number == 4:
            return v - (1 << 64) if v >> 63 else v
        if number == 5:
            return v
        if number == 6:
            return (v >> 1) ^ -(v & 1)
        if number == 7:
            return bool(v)
    return None


def _packed(data: bytes) -> list[int]:
    out, value, shift = [], 0, 0
    for byte in data:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            out.append(value)
            value = shift = 0
    return out


def tile_features(content: bytes) -> list[tuple[str, dict]]:
    """(layer, attributes) of each feature of a Mapbox vector tile, in order."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    out = []
    for number, layer in message_fields(content):
        if number != 3:
            continue
        name, keys, values, features = "", [], [], []
        for k, v in message_fields(layer):
            if k == 1:
                name = v.decode("utf-8")
            elif k == 2:
                features.append(v)
            elif k == 3:
                keys.append(v.decode("utf-8"))
            elif k == 4:
                values.append(_value(v))
        for feature in features:
            tags = [t for k, v in message_fields(feature) if k == 2 for t in _packed(v)]
            out.append((name, {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}))
    return out


#: A file's ending, its format, and the format's adapter.
FORMATS = {
    ".pdf": "pdf",
    ".csv": "csv",
    ".xlsx": "xlsx",
    ".xls": "xlsx",
    ".txt": "txt",
    ".md": "md",
    ".html": "html",
    ".htm": "html",
    ".json": "json",
    ".pbf": "pbf"
} | dict.fromkeys((".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp"), "imagen")
ADAPTERS: dict[str, Callable[[str, bytes, Options], tuple[str, dict]]] = {
    "pdf": pdf_file,
    "csv": csv_file,
    "xlsx": excel_file,
    "txt": text_file,
    "md": text_file,
    "html": html_file,
    "json": json_file,
    "imagen": image_file,
}


def doc_file(path: str, content: bytes, options: Options) -> tuple[str, dict]:
    """A document of the old binary format, or a newer one under the old ending."""
    return docx_file(path, content, options) if zipfile.is_zipfile(io.BytesIO(content)) else (doc_text(content), {})


def load_document(path: str, content: bytes, options: Options | None = None) -> str:
    """Text of one .pdf, .docx, .doc or .txt; ValueError for others."""
    ending = "." + path.rpartition(".")[2].lower()
    own = {".pdf": pdf_file, ".docx": docx_file, ".doc": doc_file, ".txt": text_file}.get(ending)
    if own is None:
        raise ValueError(f"no loader for {ending}")
    return own(path, content, options or Options())[0]
