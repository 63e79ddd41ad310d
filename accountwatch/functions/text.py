"""Text expressions on columns; all of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BLANK = "".join(f"\\u{ord(c):04x}" for c in BLANKS)
_INLINE_BLANK = "".join(f"\\u{ord(c):04x}" for c in BLANKS if c != "\n")

# Everything up to the first line that opens with "Hi " and a name.
_PREAMBLE = rf"(?s)\A.*?\n(?=[{_INLINE_BLANK}]*[Hh][Ii] [{_INLINE_BLANK}]*[^{_BLANK}])"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def strip_preamble(draft: Column | str) -> Column:
    """Drop every line before the greeting; a draft without one is only trimmed."""
    draft = F.col(draft) if isinstance(draft, str) else draft
    return strip(F.regexp_replace(F.concat(F.lit("\n"), strip(draft)), _PREAMBLE, ""))


def contact_address(name: Column | str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.concat(F.lit("contact@"), F.translate(F.lower(name), " ,", ""), F.lit(".com"))
