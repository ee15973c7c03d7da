"""Text expressions: strip, line splitting, token estimate, tokenizer.

All are built-in Spark expressions (regex classes written out so Java's regex
dialect agrees with Python's ``str.strip`` / ``str.splitlines``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from engram.config import CHARS_PER_TOKEN

# Characters Python's str.strip()/str.isspace() treat as whitespace (fixed values).
WS_CLASS = (r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Line boundaries of Python's str.splitlines() (fixed values): \r\n, \n, \r,
# \v, \f, \x1c, \x1d, \x1e, \x85,  ,  .
LINE_BREAKS = r"\r\n|[\n\x0B\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
# Token boundary for the lexical index: anything that is not a letter or digit.
NON_WORD = r"[^\p{L}\p{N}]+"


# The same set as literal characters, for btrim (a character-set trim, no regex).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
            + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(c: Column) -> Column:
    """``str.strip()`` with Python's whitespace set (SQL ``trim`` strips only spaces)."""
    return F.btrim(c, F.lit(WS_CHARS))


def is_blank(c: Column) -> Column:
    return F.length(py_strip(c)) == 0


def est_tokens(c: Column) -> Column:
    """OP-17: ``max(1, len(text) // 4)`` on code points."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / CHARS_PER_TOKEN)).cast("long")


def split_lines(c: Column) -> Column:
    """``str.splitlines()`` as an array (a trailing break yields no extra line)."""
    parts = F.split(c, LINE_BREAKS, -1)
    # splitlines drops the empty piece after a final line break
    return F.when(F.regexp_like(c, F.lit(f"(?:{LINE_BREAKS})\\z")),
                  F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def tokens(c: Column) -> Column:
    """Lower-cased terms split on non-alphanumerics, empties dropped."""
    return F.filter(F.split(F.lower(c), NON_WORD, -1), lambda t: F.length(t) > 0)


def normalized(c: Column) -> Column:
    """Normalised text for duplicate detection: lower, whitespace runs to one blank, stripped."""
    return py_strip(F.regexp_replace(F.lower(c), f"{WS_CLASS}+", " "))
