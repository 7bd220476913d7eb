"""Unicode-aware text primitives as Column expressions.

Lengths and offsets are code points everywhere. The whitespace and digit sets are spelled
out because the JVM's ``\\s`` and ``\\d`` are narrower than the sets the data model uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Unicode-aware whitespace stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex: the JVM's Unicode whitespace property plus the four separators it
# lacks. The property is one lookup per character, three times faster than a spelled-out class.
UNICODE_SPACE = r"(?U)[\s\x1c-\x1f]"
# Digit characters outside \p{Nd} (superscripts, subscripts, circled and so on).
DIGIT_EXTRA = (
    r"\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}"
    r"\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
# Latin letters, with the two code points whose lower case starts with one.
LATIN = r"A-Za-z\x{130}\x{212a}"
HANGUL = r"\x{ac00}-\x{d7a3}"
ALNUM = r"\p{L}\p{N}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``, however often that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(col: Column) -> Column:
    """Remove Unicode whitespace at both ends; only the ends of the string are touched."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """True for null, empty and whitespace-only strings."""
    return F.coalesce(F.length(strip(col)) == 0, F.lit(True))


def count_in(col: Column, char_class: str) -> Column:
    """How many characters of ``col`` belong to the class."""
    return F.length(F.regexp_replace(col, f"[^{char_class}]+", ""))


def collapse_whitespace(col: Column) -> Column:
    """Every whitespace run becomes one space."""
    return F.regexp_replace(col, f"{UNICODE_SPACE}+", " ")


def preview(col: Column, size: int = 100) -> Column:
    """Leading ``size`` characters followed by an ellipsis."""
    return F.concat(F.substring(col, 1, size), F.lit("..."))
