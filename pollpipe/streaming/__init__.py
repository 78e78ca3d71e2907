from .feeds import stream_bronze, stream_features, stream_silver
from .stateful import stream_features_stateful

__all__ = ["stream_bronze", "stream_features", "stream_features_stateful", "stream_silver"]
