"""Times of the tick tests."""

from datetime import datetime, timezone

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def seconds_of(when: datetime) -> float:
    """Seconds after START of a collected timestamp (local time of the driver)."""
    return round(when.astimezone(timezone.utc).timestamp() - START.timestamp(), 6)
