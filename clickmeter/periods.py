"""Closed UTC periods as job arguments."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

CADENCES = {"hour": timedelta(hours=1), "day": timedelta(days=1)}


def parse(text: str) -> datetime:
    """ISO text to a UTC time; text without an offset is UTC."""
    time = datetime.fromisoformat(text)
    return time.replace(tzinfo=UTC) if time.tzinfo is None else time.astimezone(UTC)


def text(time: datetime) -> str:
    """A UTC time as bucket text."""
    return time.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def last_closed(as_of: datetime, cadence: str = "hour") -> tuple[datetime, datetime]:
    """The last whole hour (or day) that is over at `as_of`, as `[start, end)`."""
    end = as_of.astimezone(UTC).replace(minute=0, second=0, microsecond=0)
    if cadence == "day":
        end = end.replace(hour=0)
    return end - CADENCES[cadence], end


def micros(time: datetime) -> int:
    """Microseconds since 1970."""
    return (utc(time) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def utc(time: datetime) -> datetime:
    """The time in UTC; one without an offset could be any hour and is refused."""
    if time.tzinfo is None:
        raise ValueError(f"{time} has no offset")
    return time.astimezone(UTC)
