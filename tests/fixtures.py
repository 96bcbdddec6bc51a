"""Seeded raw-series fixtures in the documented shape (JSON arrays of
``{"data": "dd/MM/yyyy", "valor": "<rate>"}``), written to temp folders."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
from pathlib import Path


def business_days(first: dt.date, last: dt.date) -> list[dt.date]:
    out, d = [], first
    while d <= last:
        if d.weekday() < 5:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


def month_starts(first: dt.date, months: int) -> list[dt.date]:
    out, y, m = [], first.year, first.month
    for _ in range(months):
        out.append(dt.date(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def fmt(d: dt.date) -> str:
    return d.strftime("%d/%m/%Y")


def write_raw(folder: Path, name: str, records: list[dict], mtime: float | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(json.dumps(records))
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def daily_records(days: list[dt.date], seed: int = 42) -> list[dict]:
    rnd = random.Random(seed)
    return [{"data": fmt(d), "valor": f"{0.01 + rnd.random() * 0.05:.6f}"} for d in days]


def monthly_records(months: list[dt.date], seed: int = 7) -> list[dict]:
    rnd = random.Random(seed)
    return [{"data": fmt(m), "valor": f"{-0.5 + rnd.random() * 1.5:.2f}"} for m in months]


FIVE_YEARS_DAYS = business_days(dt.date(2020, 1, 1), dt.date(2024, 12, 31))
FIVE_YEARS_MONTHS = month_starts(dt.date(2020, 1, 1), 60)
