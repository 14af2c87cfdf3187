"""PDF files made of the documents table, read again: text of pages and their order."""

from __future__ import annotations

import base64
import struct
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.corpus import reading_order
from ..sources.files import pdf_blocks
from .durable import spread
from .registry import query, table
from .text_queries import s_words

LINE, PAGE = 12, 40
_MAP = b"""/CIDInit /ProcSet findresource begin 12 dict begin begincmap 1 begincodespacerange <0000> <FFFF> endcodespacerange
1 beginbfrange <0000> <FFFF> <0000> endbfrange endcmap end end"""


def _stream(data: bytes, kind: int, entries: bytes = b"") -> bytes:
    """A stream: plain, deflated, or deflated and in ASCII."""
    if kind:
        data, entries = zlib.compress(data), entries + b"/Filter /FlateDecode"
    if kind == 3:
        data, entries = base64.a85encode(data) + b"~>", entries.replace(b"/FlateDecode", b"[/ASCII85Decode /FlateDecode]")
    return b"<<" + entries + b"/Length %d>>\nstream\n" % len(data) + data + b"\nendstream"


def compose(text: str, kind: int) -> bytes:
    """A PDF with LINE words a line and PAGE lines a page. kind 0: plain; 1: deflated; 2: with object streams; 3: in ASCII; 4: with a damaged table."""
    words = text.split()
    lines = [" ".join(words[k : k + LINE]) for k in range(0, len(words), LINE)]
    pages = [lines[k : k + PAGE] for k in range(0, len(lines), PAGE)] or [[]]
    font = b"<</Type /Font /Subtype /Type0 /Encoding /Identity-H /ToUnicode 4 0 R /DescendantFonts [<</DW 500>>]>>"
    kids = b" ".join(b"%d 0 R" % (5 + 2 * k) for k in range(len(pages)))
    objects = {1: b"<</Type /Catalog /Pages 2 0 R>>", 2: b"<</Type /Pages /Count %d /Kids [%s]>>" % (len(pages), kids), 3: font, 4: _stream(_MAP, kind)}
    for k, page in enumerate(pages):
        shown = b"".join(b"<%s> Tj T*\n" % x.encode("utf-16-be", "surrogatepass").hex().encode() for x in page)
        objects[5 + 2 * k] = b"<</Type /Page /Parent 2 0 R /MediaBox [0 0 600 800] /Contents %d 0 R /Resources <</Font <</F 3 0 R>>>>>>" % (6 + 2 * k)
        objects[6 + 2 * k] = _stream(b"BT /F 10 Tf 14 TL 40 760 Td\n" + shown + b"ET", kind)
    out, places, packed = bytearray(b"%PDF-1.5\n"), {}, {}
    if kind == 2:
        packed = {n: x for n, x in objects.items() if not x.endswith(b"endstream")}
        heads, body = b"", b""
        for n, x in packed.items():
            heads, body = heads + b"%d %d " % (n, len(body)), body + x + b" "
        holder = max(objects) + 1
        objects[holder] = _stream(heads + body, 1, b"/Type /ObjStm /N %d /First %d" % (len(packed), len(heads)))
    for n, x in objects.items():
        if n not in packed:
            places[n] = len(out)
            out += b"%d 0 obj\n" % n + x + b"\nendobj\n"
    start, size = len(out), max(objects) + 2
    if kind == 2:
        own = {**{n: (2, holder, k) for k, n in enumerate(packed)}, **{n: (1, at, 0) for n, at in places.items()}, size - 1: (1, start, 0)}
        rows = b"".join(b"\2" + bytes(a - b & 255 for a, b in zip(now, old)) for now, old in _pairs([struct.pack(">BIH", *own.get(n, (0, 0, 0))) for n in range(size)]))
        table = _stream(rows, 1, b"/Type /XRef /W [1 4 2] /Size %d /Root 1 0 R /DecodeParms <</Predictor 12 /Columns 7>>" % size)
        out += b"%d 0 obj\n" % (size - 1) + table + b"\nendobj\n"
    elif kind < 4:
        out += b"xref\n0 %d\n0000000000 65535 f \n" % (size - 1) + b"".join(b"%010d 00000 n \n" % places[n] for n in range(1, size - 1))
    out += b"trailer\n<</Size %d /Root 1 0 R>>\n" % size if kind != 2 else b""
    return bytes(out + b"startxref\n%d\n%%%%EOF" % (start if kind < 4 else 7))


def _pairs(rows: list[bytes]) -> list[tuple[bytes, bytes]]:
    return [*zip(rows, [bytes(len(rows[0])), *rows], strict=False)]


@F.pandas_udf(T.BinaryType())
def _composed(text: pd.Series, kind: pd.Series) -> pd.Series:
    return pd.Series([compose(t, k) for t, k in zip(text, kind, strict=True)])


@query(
    f"""
WITH w AS (SELECT doc_id, {s_words("text")} AS ws FROM documents),
l AS (SELECT doc_id, list_transform(range(0, len(ws), {LINE}), lambda s: array_to_string(ws[s + 1:s + {LINE}], ' ')) AS ls FROM w)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, array_to_string(list_transform(range(0, len(ls), {PAGE}), lambda s: array_to_string(ls[s + 1:s + {PAGE}], chr(10))), chr(10) || chr(10)) AS text FROM l
"""
)
def pdf_text(spark, sf_dir):
    """Documents as PDF files of five kinds, their blocks read and put in order."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    files = docs.select(F.col("doc_id").cast("string").alias("fuente"), _composed("text", (F.col("doc_id") % 5).cast("int")).alias("content"))
    return reading_order(pdf_blocks(files))
