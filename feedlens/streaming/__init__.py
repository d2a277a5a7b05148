from feedlens.streaming.ingest import event_table, start_ingest_job
from feedlens.streaming.slots import score_slots, slot_stream, start_slot_job, stream_events

__all__ = ["event_table", "score_slots", "slot_stream", "start_ingest_job", "start_slot_job", "stream_events"]
