"""Readers of the raw sources and the catalogue of named tables."""

from deskmeter.sources.raw import (
    read_events,
    read_messages,
    read_predictions,
    read_table,
    read_tickets,
)

__all__ = ["read_events", "read_messages", "read_predictions", "read_table", "read_tickets"]
