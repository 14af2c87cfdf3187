"""Text functions that need Python: Arrow batches in, Arrow batches out."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LINE_LENGTH, REPEATS

_SPACES = {0xA0: " ", 0x200B: " ", 0x200C: " ", 0x200D: " ", 0xFEFF: " "}
_GONE = {c: None for c in (*range(0x20), *range(0x7F, 0xA0)) if chr(c) not in "\t\n\r"}
_CLEAN = _GONE | _SPACES  # both happen in one pass: no odd space is a control character
_BLANKS, _FEEDS = re.compile(r"[ \t]{2,}"), re.compile(r"\n{3,}")


def clean(text: str | None, least: int = REPEATS, longest: int = LINE_LENGTH) -> str:
    """Control characters out, NFC, repeated short lines out, white space collapsed; '' for null. See text.py for each step."""
    if not text:
        return ""
    text = text.translate(_CLEAN)
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    if text.count("\n") >= least - 1:
        lines = text.split("\n")
        bare = [x.strip() for x in lines]
        often = {x for x, n in Counter(bare).items() if n >= least and x and len(x) <= longest}
        if often:
            text = "\n".join([x for x, b in zip(lines, bare, strict=True) if b not in often])
    text = _FEEDS.sub("\n\n", _BLANKS.sub(" ", text))
    return "\n".join([x.strip() for x in text.split("\n")]).strip()


#: Texts of a batch whose results are Python's own strings at once.
CLEANED_ROWS = 64


def cleaned(texts: pa.Array) -> pa.Array:
    """clean() of an array, one text as a Python string at a time: a batch is held as Arrow alone, before and after."""
    slices = (texts.slice(at, CLEANED_ROWS) for at in range(0, max(len(texts), 1), CLEANED_ROWS))
    return pa.concat_arrays([pa.array([clean(t.as_py()) for t in part], texts.type) for part in slices])


@F.arrow_udf(T.StringType())
def clean_text(texts: pa.Array) -> pa.Array:
    """clean() of a column; never null."""
    return cleaned(texts)


@F.pandas_udf(T.StringType())
def normalize_nfc(texts: pd.Series) -> pd.Series:
    """Unicode's composed form."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def norm_key(key: object) -> str:
    """A key without accents and other non-ASCII characters, stripped, in lower case."""
    return unicodedata.normalize("NFKD", str(key)).encode("ascii", "ignore").decode().strip().lower()


@F.pandas_udf(T.StringType())
def normalize_key(keys: pd.Series) -> pd.Series:
    return keys.map(lambda k: None if k is None else norm_key(k))


# What HTML elements become.
HIDDEN = frozenset({"script", "style", "head", "noscript"})
MARKS = {f"h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)} | {"li": "\n- "} | dict.fromkeys(("p", "div", "tr", "section", "article", "br"), "\n\n")


_OPEN, _CLOSE, _SHOWN = 1, -1, 0
#: How a token changes the number of hidden elements that are open.
_DEEPER = {(way, tag): way for way in (_OPEN, _CLOSE) for tag in HIDDEN}
_MARKED = {(_OPEN, tag): mark for tag, mark in MARKS.items() if tag not in HIDDEN}


class _Tokens(HTMLParser):
    """A page as (way, tag or text)."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[int, str]] = []
        self.handle_starttag = lambda tag, _: self.found.append((_OPEN, tag))
        self.handle_endtag = lambda tag: self.found.append((_CLOSE, tag))
        self.handle_data = lambda text: self.found.append((_SHOWN, text))
        self.feed(html)


def outline(html: str | None) -> str:
    """A page as text with Markdown-like headings and lists. The parser isn't closed: an unfinished entity at the very end stays behind."""
    tokens = _Tokens(html).found if html else []
    hidden = accumulate((_DEEPER.get(token, 0) for token in tokens), lambda depth, change: max(depth + change, 0))
    shown = (f"{token[1].strip()} " if token[0] == _SHOWN and not depth else _MARKED.get(token, "") for token, depth in zip(tokens, hidden, strict=True))
    return "".join(piece for piece in shown if piece != " ")


@F.pandas_udf(T.StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    return pages.map(outline)
