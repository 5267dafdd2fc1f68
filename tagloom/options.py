"""Job options and their precedence."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed defaults.
DEFAULT_INTERVAL_SECONDS = 60
DEFAULT_WINDOW_SECONDS = 300
DEFAULT_TAG_PARTITION_SIZE = 500
DEFAULT_BATCH_ROWS = 10_000
DEFAULT_PUBLISH_RETRIES = 3
DEFAULT_RETRY_SLEEP_SECONDS = 2.0


@dataclass(frozen=True)
class ReadOptions:
    interval_seconds: int = DEFAULT_INTERVAL_SECONDS
    window_seconds: int = DEFAULT_WINDOW_SECONDS
    tag_partition_size: int = DEFAULT_TAG_PARTITION_SIZE
    batch_rows: int = DEFAULT_BATCH_ROWS
    publish_retries: int = DEFAULT_PUBLISH_RETRIES
    retry_sleep_seconds: float = DEFAULT_RETRY_SLEEP_SECONDS

    def __post_init__(self) -> None:
        for name in ("interval_seconds", "window_seconds", "tag_partition_size", "batch_rows"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than zero")


def effective_read_options(
    mode: ReadOptions | None, site: ReadOptions | None, default: ReadOptions | None = None
) -> ReadOptions:
    """Mode beats site beats default, as whole objects and not field by field."""
    return mode or site or default or ReadOptions()
