from kestrel.functions.scalars import (
    falsy_coalesce,
    iso_text,
    json_bytes,
    nonempty,
    story_key,
    timestamp_text,
)

__all__ = ["falsy_coalesce", "iso_text", "json_bytes", "nonempty", "story_key", "timestamp_text"]
