"""Snake-case column names (P10), applied to a whole DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# A word starts where an upper-case run begins, and at the last capital of a
# run when a lower-case letter follows it (``HTMLPage`` -> ``HTML``, ``Page``).
_WORD_START = re.compile(r"(?<![A-Z])(?=[A-Z])|(?=[A-Z][a-z])")


def snake_case(text: str) -> str:
    """``PolicyId`` -> ``policy_id``; ``HTMLPage`` -> ``html_page``.

    Hyphens and blanks separate words; other characters (``_``, digits) stay
    inside the word they are in, so ``Policy_Id`` -> ``policy__id``.
    """
    spaced = _WORD_START.sub(" ", text.replace("-", " "))
    return "_".join(spaced.split()).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; refuse if two names collide."""
    renames = {c: snake_case(c) for c in df.columns}
    seen: dict[str, str] = {}
    for old, new in renames.items():
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both become {new!r}")
        seen[new] = old
    return df.withColumnsRenamed({o: n for o, n in renames.items() if o != n})
