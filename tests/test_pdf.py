"""The package's own reader of PDF files."""

import zlib

import pytest

from sedimenta.operators.corpus import reading_order
from sedimenta.plans.pdf_queries import LINE, PAGE, compose
from sedimenta.sources import adapters as ad
from sedimenta.sources import files, pdf


def document(content, font=b"<</Type /Font /Subtype /Type1 /Encoding /WinAnsiEncoding>>", page=b"", more=(), entries=b"", stream=None):
    """A file of one page with a content stream; more: further objects from number 6 on."""
    stream = stream or b"<<%s/Length %d>>\nstream\n%s\nendstream" % (entries, len(content), content)
    objects = [
        b"<</Type /Catalog /Pages 2 0 R>>",
        b"<</Kids [3 0 R] /Count 1 /Resources <</Font <</F1 5 0 R>> /XObject <</X 6 0 R>>>> /MediaBox [0 0 600 800]>>",
        b"<</Type /Page /Parent 2 0 R /Contents 4 0 R %s>>" % page,
        stream,
        font,
        *more,
    ]
    out, places = b"%PDF-1.4\n", []
    for n, x in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (n, x)
    table = b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    return out + table + b"trailer\n<</Size %d /Root 1 0 R /Info <</Title (A \\(small\\) title)>>>>\nstartxref\n%d\n%%%%EOF" % (len(objects) + 1, len(out))


def texts(raw):
    return [[b[2] for b in page] for page in pdf.blocks(raw)]


TEXT = "Zażółć gęślą jaźń 日本語 😀 niño " * 200


@pytest.mark.parametrize("kind", range(5))
def test_kinds_of_files(kind):
    raw = compose(TEXT, kind)
    assert "\n".join(x for page in texts(raw) for x in page).split() == TEXT.split()
    assert len(pdf.blocks(compose("", kind))) == 1
    cut = raw[: raw.rindex(b"startxref")] + b"startxref\n999999\n"  # the table isn't where it should be
    assert texts(cut) == texts(raw)


def test_columns_are_read_one_after_the_other_by_their_tops():
    left = b" ".join(b"1 0 0 1 50 %d Tm (left %d) Tj" % (700 - 12 * k, k) for k in range(3))
    right = b" ".join(b"1 0 0 1 300 %d Tm (right %d) Tj" % (690 - 12 * k, k) for k in range(3))
    head = b"1 0 0 1 50 760 Tm (Head) Tj"
    raw = document(b"BT /F1 10 Tf " + right + b" " + left + b" " + head + b" ET")
    assert texts(raw) == [["right 0\nright 1\nright 2", "left 0\nleft 1\nleft 2", "Head"]]
    assert ad.pdf_file("x.pdf", raw, ad.Options(ocr=False)) == (
        "Head\nleft 0\nleft 1\nleft 2\nright 0\nright 1\nright 2",
        {"num_paginas": 1, "titulo_pdf": "A (small) title"},
    )


def test_strings_gaps_and_states():
    content = rb"""q 2 0 0 2 0 0 cm BT /F1 10 Tf 12 TL 20 300 Td [(wo) -20 (rd) -400 (next)] TJ T* (a\(b\)\\ \141\r\
c) Tj (line) ' 0 0 (quoted) " <48 69 2> Tj ET Q BI /W 1 /H 1 ID x(EI BT) EI BT /F1 10 Tf 1 0 0 1 40 100 Tm (\351t\351 % no comment) Tj % comment
ET BT /F9 9 Tf (no font) Tj 1 Tf Tj ET"""
    assert texts(document(content)) == [["word next\na(b)\\ a\rc\nline\nquotedHi", "été % no comment"]]


def test_fonts():
    named = b"<</Type /Font /Subtype /Type1 /Encoding <</Differences [65 /eacute /Ccedilla /uni4E2D /u1F600 /germandbls /fi /unknown]>>>>"
    assert texts(document(b"BT /F1 10 Tf 9 100 Td (ABCDEFGH) Tj ET", named)) == [["éÇ中😀ßfiGH"]]
    mapped = b"<</Type /Font /Subtype /TrueType /ToUnicode 6 0 R>>"
    table = b"1 begincodespacerange <00> <FF> endcodespacerange 1 beginbfchar <41> <0061006B> endbfchar 2 beginbfrange <42> <43> <03B1> <44> <45> [<0041> <D83DDE00>] endbfrange"
    stream = b"<</Length %d>>stream\n%s\nendstream" % (len(table), table)
    assert texts(document(b"BT /F1 10 Tf 9 100 Td (ABCDEF) Tj ET", mapped, more=[stream])) == [["akαβA😀F"]]
    wide = b"<</Type /Font /Subtype /Type0 /ToUnicode 6 0 R /DescendantFonts [<</W [65 [200 300] 67 68 400] /DW 900>>]>>"
    stream = stream.replace(b"<00> <FF>", b"<0000> <FFFF>").replace(b"<41>", b"<0041>")
    assert texts(document(b"BT /F1 10 Tf 9 100 Td <0041> Tj ET", wide, more=[stream])) == [["ak"]]


def lzw(data):
    table, width, bits, held = {bytes([k]): k for k in range(256)}, 9, "", b""
    out = f"{256:09b}"
    for k in range(len(data)):
        c = data[k : k + 1]
        if held + c in table:
            held += c
            continue
        out += f"{table[held]:0{width}b}"
        table[held + c] = len(table) + 2
        width = max(9, (len(table) + 2 + 0).bit_length()) if len(table) + 2 >= 511 else 9
        held = c
    out += f"{table[held]:0{width}b}"
    out += f"{257:0{width}b}"
    return int(out.ljust(-(-len(out) // 8) * 8, "0"), 2).to_bytes(-(-len(out) // 8))


def test_filters():
    content = b"BT /F1 10 Tf 9 100 Td (some text, some text, some text) Tj ET"
    want = [["some text, some text, some text"]]
    for entries, data in (
        (b"/Filter /LZWDecode", lzw(content)),
        (b"/Filter [/ASCIIHexDecode]", content.hex().encode() + b">"),
        (b"/Filter /RunLengthDecode", b"".join(bytes([len(content[k : k + 100]) - 1]) + content[k : k + 100] for k in range(0, len(content), 100)) + b"\x80"),
        (b"/Filter /FlateDecode", zlib.compress(content)[:-6]),
    ):
        assert texts(document(data, entries=entries)) == want
    with pytest.raises(ValueError, match="filter"):
        texts(document(b"x", entries=b"/Filter /JBIG2Decode"))
    plain = bytes(range(60)) * 3
    for how in range(5):
        rows = b""
        for r in range(0, len(plain), 9):
            line, up = plain[r : r + 9], plain[r - 9 : r] if r else bytes(9)
            for k in range(9):
                a, b, c = (line[k - 3], up[k], up[k - 3]) if k >= 3 else (0, up[k], 0)
                p = a + b - c
                paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
                rows += (bytes([how]) if k == 0 else b"") + bytes([line[k] - (0, a, b, (a + b) // 2, paeth)[how] & 255])
        assert pdf._unpredicted(rows, {"Predictor": 15, "Colors": 3, "Columns": 3}) == plain


def test_forms_and_rotation():
    inner = b"BT /F1 10 Tf 5 5 Td (in a form) Tj ET /X Do"
    form = b"<</Type /XObject /Subtype /Form /Matrix [1 0 0 1 100 200] /Length %d>>stream\n%s\nendstream" % (len(inner), inner)
    found = pdf.blocks(document(b"/X Do", more=[form]))
    assert found[0][0][2] == "in a form"
    turned = document(b"BT /F1 10 Tf 0 1 -1 0 480 100 Tm (up) Tj ET BT /F1 10 Tf 0 1 -1 0 500 100 Tm (down) Tj ET", page=b"/Rotate 90")
    (up, down), = pdf.blocks(turned)
    assert (up[2], down[2]) == ("up", "down") and up[1] < down[1]


@pytest.mark.parametrize("raw", [b"", b"%PDF-", b"%PDF-1.4\n1 0 obj\n<</Type /Catalog /Pages 1 0 R>>\nendobj\ntrailer <</Root 1 0 R>>", b"[" * 5000, b"\0" * 100])
def test_no_pages(raw):
    with pytest.raises(ValueError):
        pdf.blocks(raw)
    assert pdf.title(raw) is None


def test_encrypted():
    with pytest.raises(ValueError, match="encrypted"):
        pdf.blocks(document(b"").replace(b"/Info", b"/Encrypt <<>> /Info"))


def test_damaged_anywhere():
    """Whatever byte is damaged, there are blocks or a ValueError."""
    for raw in (compose("some words " * 9, 2), document(b"BT /F1 10 Tf 9 100 Td (some text) Tj ET")):
        for k in range(0, len(raw), 7):
            for byte in (b"\0", b">", b"9"):
                try:
                    pdf.blocks(raw[:k] + byte + raw[k + 1 :])
                except ValueError:
                    pass


def test_blocks_as_rows(spark):
    rows = [("a.pdf", compose("uno dos " * 300, 1)), ("b.pdf", b"broken"), ("c.pdf", compose("", 0))]
    table = spark.createDataFrame(rows, "fuente string, content binary")
    found = files.pdf_blocks(table).cache()
    assert [(r.doc_id, r.error) for r in found.where("error is not null").collect()] == [("b.pdf", "ValueError: a PDF without pages")]
    assert {r.page for r in found.where("doc_id = 'a.pdf'").collect()} == {1, 2}
    told = {r.doc_id: r.text for r in reading_order(found.where("error is null")).collect()}
    assert told["a.pdf"].split() == ["uno", "dos"] * 300 and told["c.pdf"] == ""
    named = spark.createDataFrame([(f, "pdf", c) for f, c in rows], "fuente string, formato string, content binary")
    got = {r.fuente: (r.texto, r.error) for r in files.extract(named).collect()}
    assert got["a.pdf"] == (told["a.pdf"], None) and got["b.pdf"] == ("", "ValueError: a PDF without pages")


def test_long_ranges_are_looked_up_and_fonts_read_once(monkeypatch):
    codes, sizes = pdf.character_map(
        b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0041> <0058> endbfchar 2 beginbfrange <0000> <FFFF> <0000> "
        b"<0061> <0062> <0031> endbfrange 1 beginbfchar <0043> <0059> endbfchar"
    )
    assert len(codes) == 3 and sizes == {2}
    assert [codes[c.encode("utf-16-be")].decode("utf-16-be") for c in "ABCabcé"] == ["A", "B", "Y", "1", "2", "c", "é"]
    with pytest.raises(KeyError):
        codes[b"A"]
    made, own = [], pdf.character_map
    monkeypatch.setattr(pdf, "character_map", lambda data: made.append(1) or own(data))
    words = [f"w{k}é" for k in range(3 * LINE * PAGE)]
    pages = pdf.blocks(compose(" ".join(words), 1))
    assert len(pages) == 3 and len(made) == 1
    assert " ".join(b[2] for page in pages for b in page).split() == words
