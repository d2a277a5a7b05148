from feedlens.sources.schema import CUBE_SCHEMA, FEED_SCHEMA, MESSAGE_SCHEMA, REPORT_SCHEMA, conform
from feedlens.sources.tables import TableRef, read_feed, read_messages
from feedlens.sources.fixtures import feed_from_events, messages_from_events, load_fixture
from feedlens.sources.sinks import ensure_cube_table, write_cube, write_report

__all__ = [
    "CUBE_SCHEMA", "FEED_SCHEMA", "MESSAGE_SCHEMA", "REPORT_SCHEMA", "conform",
    "TableRef", "read_feed", "read_messages",
    "feed_from_events", "messages_from_events", "load_fixture",
    "ensure_cube_table", "write_cube", "write_report",
]
