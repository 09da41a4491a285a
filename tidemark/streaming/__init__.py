from tidemark.streaming.loader import apply_batch, start_source_stream, start_stream

__all__ = ["apply_batch", "start_source_stream", "start_stream"]
