from retailgold.streaming.arrivals import read_notifications, read_ready, stream_arrivals, stream_completeness
from retailgold.streaming.gold import read_rejected, stream_gold
from retailgold.streaming.overdue import date_states, read_date_states, stream_date_states

__all__ = [
    "date_states", "read_date_states", "read_notifications", "read_ready", "read_rejected", "stream_arrivals", "stream_completeness",
    "stream_date_states", "stream_gold",
]
