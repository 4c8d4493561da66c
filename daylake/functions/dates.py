"""Resolve the run's date window before anything is planned.

Both forms are accepted: ISO ``YYYY-MM-DD`` (bronze arguments) and compact
``YYYYMMDD`` (gold arguments). Parsing is strict; "today" is a parameter so
that runs and tests are repeatable.
"""

from __future__ import annotations

import datetime as dt

# Fixed value (same as the reference): the word that means "the day before
# today".
CRON = "cron"


def _parse(value: str) -> dt.date:
    text = value.strip()
    if len(text) == 10 and text[4] == "-" and text[7] == "-":
        return dt.date(int(text[:4]), int(text[5:7]), int(text[8:]))
    if len(text) == 8 and text.isdigit():
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))
    raise ValueError(f"not a date (YYYY-MM-DD or YYYYMMDD): {value!r}")


def to_compact(value: str) -> str:
    return _parse(value).strftime("%Y%m%d")


def to_iso(value: str) -> str:
    return _parse(value).isoformat()


def resolve_window(start_date: str | None = None, final_date: str | None = None,
                   reprocess_all: bool = False, today: dt.date | None = None,
                   days_ago: int = 1) -> tuple[str | None, str | None]:
    """Return ``(start, final)`` as ISO dates, both ends included; ``None`` is
    an open end, so a file of any date is inside a window without limits.

    * ``reprocess_all`` -> everything up to today;
    * ``start == 'cron'`` -> ``days_ago`` days before today;
    * ``final == 'cron'`` -> the resolved start (without one, the same day as
      ``start == 'cron'``).
    """
    today = today or dt.date.today()
    if reprocess_all:
        return None, today.isoformat()
    if start_date is None or start_date == "":
        start = None
    elif start_date == CRON:
        start = (today - dt.timedelta(days=days_ago)).isoformat()
    else:
        start = to_iso(start_date)
    if final_date is None or final_date == "":
        final = None
    elif final_date == CRON:
        final = start or (today - dt.timedelta(days=days_ago)).isoformat()
    else:
        final = to_iso(final_date)
    return start, final


def resolve_day(day: str | None = None, today: dt.date | None = None,
                days_ago: int = 1) -> str:
    """One business day as ``YYYYMMDD``; ``'cron'`` or empty -> yesterday."""
    today = today or dt.date.today()
    if not day or day == CRON:
        return (today - dt.timedelta(days=days_ago)).strftime("%Y%m%d")
    return to_compact(day)


def split_day(day: str) -> tuple[str, str, str]:
    """``YYYYMMDD`` -> ``('YYYY', 'MM', 'DD')``, zero-padded strings."""
    compact = to_compact(day)
    return compact[:4], compact[4:6], compact[6:]
