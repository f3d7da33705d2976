"""When a stream runs."""

from __future__ import annotations

CHECKPOINT_SECONDS = 10
FLUSH_SECONDS = 3


def trigger_options(seconds: int | None) -> dict:
    """Every `seconds`, or once over all that is there now and then stop."""
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}
