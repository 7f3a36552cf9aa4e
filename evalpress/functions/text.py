"""Text column jobs: marker blocks, leak matches."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def marker_block(text: Column | str, marker: str) -> Column:
    """The block that starts at the first line beginning with ``marker`` and
    runs to the next non-blank line without indentation, right-trimmed; null
    when there is none.  ``(?d)`` keeps ``\\n`` the only line terminator, as
    for a line-by-line reader."""
    t = F.col(text) if isinstance(text, str) else text
    pat = r"(?md)^" + re.escape(marker) + r"[^\n]*(\n([ \t][^\n]*)?)*"
    block = F.regexp_replace(F.regexp_extract(t, pat, 0), r"\s+\z", "")
    return F.nullif(block, F.lit(""))


def version_line(text: Column | str) -> Column:
    """``version: ...`` at a line start, else null."""
    t = F.col(text) if isinstance(text, str) else text
    return F.nullif(F.regexp_extract(t, r'(?md)^version:\s*"?([^"\n]+)"?', 1), F.lit(""))
