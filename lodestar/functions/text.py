"""String column functions with Python ``str`` semantics.

Java's ``\\s`` is ASCII-only and ``trim`` strips only spaces, while Python's
``re.split(r'\\s+')`` and ``str.strip()`` use ``str.isspace()``.  The class
below lists exactly the characters for which ``str.isspace()`` is true; it is
written with ``\\x{..}`` escapes that both Java regex and RE2 (DuckDB) accept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points for which Python's str.isspace() is true.
PY_SPACE = (r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
PY_NON_SPACE = "[^" + PY_SPACE[1:]


def py_strip(c: Column) -> Column:
    """SCL-2: ``str.strip()``."""
    return F.regexp_replace(c, f"^{PY_SPACE}+|{PY_SPACE}+$", "")


def py_lower_strip(c: Column) -> Column:
    """SCL-2: ``s.strip().lower()``."""
    return F.lower(py_strip(c))


def has_space(c: Column) -> Column:
    return c.rlike(PY_SPACE)


def ws_field(c: Column, i: int) -> Column:
    """Field ``i`` (0 or 1) of ``re.split(r'\\s+', s)`` without building the array.

    Only the first two fields are ever used, so a prefix match stops after the
    second blank run however long the text is.
    """
    pat = f"^({PY_NON_SPACE}*){PY_SPACE}+({PY_NON_SPACE}*)"
    return F.regexp_extract(c, pat, i + 1)


def py_split_ws(c: Column) -> Column:
    """SCL-1: ``re.split(r'\\s+', s)`` (leading / trailing blanks give '' fields)."""
    return F.split(c, f"{PY_SPACE}+", -1)


def split_once(c: Column, sep: str) -> Column:
    """SCL-1: ``re.split(sep, s, 1)`` – at most two parts."""
    return F.split(c, sep, 2)
