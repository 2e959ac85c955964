"""Times for tests."""

from __future__ import annotations

from datetime import datetime, timezone


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
