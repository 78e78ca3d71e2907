from .arrivals import Arrivals, Batch
from .polls import ENVELOPE, classify_polls, poll_failure, read_polls, stream_polls
from .tables import FeedTable, from_micros

__all__ = [
    "Arrivals", "Batch", "ENVELOPE", "FeedTable", "classify_polls", "from_micros", "poll_failure", "read_polls", "stream_polls",
]
