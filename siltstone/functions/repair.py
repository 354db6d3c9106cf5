"""Unicode repair: what can be done without a library for it.

In this order: HTML entities (unless the text has a ``<``), UTF-8 that was read as Windows-1252 or Latin-1, full and half
widths, curly quotes, ligatures, line ends, control characters, NFC.  Each part can be switched off.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed values.
LIGATURES = {"Ĳ": "IJ", "ĳ": "ij", "ŉ": "ʼn", "Ǆ": "DŽ", "ǅ": "Dž", "ǆ": "dž", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj", "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
QUOTES = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"'}

_LIGATURES, _QUOTES = str.maketrans(LIGATURES), str.maketrans(QUOTES)
_WIDTHS = {c: unicodedata.normalize("NFKC", chr(c)) for c in (0x3000, *range(0xFF01, 0xFFF0)) if unicodedata.normalize("NFKC", chr(c)) != chr(c)}
_CONTROL = {c: None for c in (*range(0x00, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, *range(0x206A, 0x2070), 0xFEFF, *range(0xFFF9, 0xFFFD))}
_LINE_ENDS = re.compile("\r\n|\r| | |\x85")
#: Two-character traces of UTF-8 that was read as a one-byte code.
_TRACE = re.compile("[ÂÃÄÅÆÇÈÉÐÑØÙâãäåæçèéïð][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]")


def unmangle(s: str) -> str:
    """Undo readings of UTF-8 as Windows-1252 or Latin-1, word by word, as long as traces of it are left."""
    return " ".join(_unmangle_word(w) if _TRACE.search(w) else w for w in s.split(" "))


def _unmangle_word(s: str) -> str:
    for _ in range(3):
        for code in ("cp1252", "latin-1"):
            try:
                s = s.encode(code).decode("utf-8")
                break
            except UnicodeError:
                pass
        else:
            break
        if not _TRACE.search(s):
            break
    return s


def repair_text(s: str, uncurl_quotes: bool = True, fix_entities: bool = True) -> str:
    if s.isascii() and "&" not in s and "\r" not in s:
        return s.translate(_CONTROL)
    if fix_entities and "&" in s and "<" not in s:
        s = html.unescape(s)
    s = "\n".join(unmangle(line) for line in s.split("\n")) if _TRACE.search(s) else s
    s = s.translate(_WIDTHS)
    s = s.translate(_QUOTES) if uncurl_quotes else s
    s = _LINE_ENDS.sub("\n", s.translate(_LIGATURES)).translate(_CONTROL)
    return unicodedata.normalize("NFC", s)


@F.pandas_udf(StringType())
def repair(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: repair_text(t) if isinstance(t, str) else None)


@F.pandas_udf(StringType())
def repair_keeping_quotes(texts: pd.Series) -> pd.Series:
    """Without uncurling quotes or reading entities."""
    return texts.map(lambda t: repair_text(t, False, False) if isinstance(t, str) else None)
