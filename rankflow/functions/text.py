"""Text expressions: whitespace strip, mojibake detection and repair,
title tokenisation.  All are built-in Spark expressions (no UDF)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------
# Mojibake marker patterns as written in the cleaning notebook: a character
# class (so only the set of characters matters).  The first is the detection
# pattern; the second (used for the whole-row scan) lacks one character; the
# third (re-check after repair) lacks another.
MOJIBAKE_PATTERN = "[ÃÂâ€™â€œâ€¢Ã±Ã©Â®Ã¼Ã¶â€•Ã¤â€“Ã¶ÃŸÃ³Ã¤Â¿ÃºÃ¡]"
MOJIBAKE_PATTERN_ROW_SCAN = "[ÃÂâ€™â€œâ€¢Ã±Ã©Â®Ã¼Ã¶â€•Ã¤â€“Ã³ÃŸÃºÃ¡]"
MOJIBAKE_PATTERN_RECHECK = "[ÃÂâ€™â€œâ€¢Ã±Ã©Ã¼Ã¶â€•Ã¤â€“Ã¶ÃŸÃ³Ã¤Â¿ÃºÃ¡]"

# Characters the title tokenizer turns into separators (then lower-cases and
# splits on a single space).
TOKEN_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
# ---------------------------------------------------------------------------

# Built by rule: every code point Python's str.strip() removes.
WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

# Built by rule: the 27 printable characters of Windows-1252 in 0x80-0x9F
# and the C1 control code points that ISO-8859-1 puts at the same bytes.
_CP1252 = []
_C1 = []
for _b in range(0x80, 0xA0):
    try:
        _CP1252.append(bytes([_b]).decode("cp1252"))
        _C1.append(chr(_b))
    except UnicodeDecodeError:
        pass
CP1252_SPECIALS = "".join(_CP1252)
C1_CONTROLS = "".join(_C1)

WS_CLASS = "[" + WHITESPACE + "]"
STRIP_PATTERN = r"\A" + WS_CLASS + "+|" + WS_CLASS + r"+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (Spark's ``trim`` removes only spaces)."""
    return F.regexp_replace(_c(c), STRIP_PATTERN, "")


def has_match(c, pattern: str) -> Column:
    """Regex search; a missing value counts as no match (``na=False``)."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def mojibake(c) -> Column:
    """Corrupt text the classic way: UTF-8 bytes read back as Windows-1252
    (``Café`` -> ``CafÃ©``).  Used to build test inputs."""
    latin = F.decode(F.encode(_c(c), "UTF-8"), "ISO-8859-1")
    return F.translate(latin, C1_CONTROLS, CP1252_SPECIALS)


def repair_mojibake(c) -> Column:
    """Undo one round of UTF-8-as-Windows-1252 decoding; text that is not
    such mojibake is returned unchanged.

    Windows-1252 specials go back to their byte values; if every character
    then fits one byte and those bytes are valid UTF-8 and contain at least
    one multi-byte sequence, the decoded text replaces the original.
    """
    col = _c(c)
    back = F.translate(col, CP1252_SPECIALS, C1_CONTROLS)
    one_byte = ~back.rlike("[^\\x{00}-\\x{FF}]")
    has_high = back.rlike("[\\x{80}-\\x{FF}]")
    raw = F.encode(back, "ISO-8859-1")
    decoded = raw.cast("string")
    ok = one_byte & has_high
    repaired = F.when(ok & F.is_valid_utf8(decoded), decoded)
    return F.when(col.isNull(), col).otherwise(F.coalesce(repaired, col))


def title_tokens(c) -> Column:
    """Tokenizer semantics: lower-case, filter characters -> space, split on
    single spaces, drop empty tokens."""
    spaced = F.translate(F.lower(_c(c)), TOKEN_FILTERS, " " * len(TOKEN_FILTERS))
    return F.filter(F.split(spaced, " "), lambda t: t != F.lit(""))
