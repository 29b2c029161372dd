"""Argument checks shared by the jobs: G5."""

from __future__ import annotations

import os
from datetime import datetime
from zoneinfo import ZoneInfo

from stockflow.functions.events import business_timezone


def business_day(value: str | None, now: datetime | None = None) -> str:
    """A checked ``yyyy-mm-dd`` day; by default today in the business time zone."""
    if not value:
        zone = ZoneInfo(business_timezone())
        return (now or datetime.now(zone)).astimezone(zone).strftime("%Y-%m-%d")
    try:
        return datetime.strptime(value, "%Y-%m-%d").strftime("%Y-%m-%d")
    except ValueError as error:
        raise ValueError(f"{value!r} is not a yyyy-mm-dd date") from error


def campaign(value: str | None) -> str:
    """A campaign id, from the argument or the environment."""
    value = value or os.getenv("CAMPAIGN_ID")
    if not value:
        raise ValueError("a campaign id is required (argument or CAMPAIGN_ID)")
    return value
