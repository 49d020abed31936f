"""Times from text, for the tests."""

from datetime import datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
