from tidemark.streaming.upsert_stream import merge_batch, stream_upsert  # noqa: F401
