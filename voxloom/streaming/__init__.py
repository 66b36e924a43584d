"""File streams: incremental builds, running totals, de-duplication."""
