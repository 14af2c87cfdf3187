"""Language of a text by character trigrams: a multinomial model, scored in batches of Arrow."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LANGUAGE_LEAST, LANGUAGE_SAMPLE

#: Bits of a character in a trigram's key.
_BITS = 21


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)


def heads(texts: pd.Series, sample: int = LANGUAGE_SAMPLE) -> list[str]:
    """The first characters of each text, without white space around."""
    return [(t or "")[:sample].strip() if isinstance(t, str) else "" for t in texts]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, key): trigrams of lower-cased letters, where whatever is no letter counts as one space, and so do both ends."""
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spaced = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(spaced)), [len(t) for t in spaced])
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of several spaces one stays
    keep[np.cumsum([0, *[len(t) for t in spaced[:-1]]])] |= True
    value, row = np.where(letter, codes, 32)[keep].astype(np.int64), row[keep]
    if len(value) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = row[:-2] == row[2:]
    keys = value[:-2] << 2 * _BITS | value[1:-1] << _BITS | value[2:]
    return row[:-2][whole], keys[whole]


def gram_text(key: int) -> str:
    return "".join(chr(key >> shift & (1 << _BITS) - 1) for shift in (2 * _BITS, _BITS, 0))


@dataclass
class LanguageModel:
    """keys: trigrams in ascending order; weights: their logarithmic probability in each of the languages, which stand in order."""

    languages: list[str]
    keys: np.ndarray
    weights: np.ndarray

    def of(self, texts: pd.Series, least: int = LANGUAGE_LEAST) -> list[str]:
        """The likeliest language; 'und' for fewer than `least` characters, and where no trigram is known. Ties: first by code."""
        own = heads(texts)
        row, keys = trigrams(own)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        row, at = row[known], at[known]
        found = np.bincount(row, minlength=len(own))
        scores = [np.bincount(row, self.weights[at, k], minlength=len(own)) for k in range(len(self.languages))]
        best = np.argmax(scores, axis=0) if scores else np.zeros(len(own), int)
        return [self.languages[b] if n and len(t) >= least else "und" for b, n, t in zip(best, found, own, strict=True)]


def detect(text: Column | str, model: LanguageModel) -> Column:
    """The language of each text by the model, which goes to the executors with the function: it has a bounded vocabulary."""

    @F.pandas_udf(T.StringType())
    def told(texts: pd.Series) -> pd.Series:
        return pd.Series(model.of(texts))

    return told(text)
