from rollcall.functions.captions import (
    caption_hashtags, caption_pieces, caption_repost, parse_caption, scrub_quotes, strip_ws,
)
from rollcall.functions.scalars import (
    folder_of, greeting_name, mtime_date, name_of, render, split_rejects, to_mb, to_pk, to_ts,
)
from rollcall.functions.times import (
    LOCAL_ZONE, run_date, run_date_text, stamp, to_local, utc_wall, weekday0,
)

__all__ = [
    "caption_hashtags", "caption_pieces", "caption_repost", "parse_caption", "scrub_quotes",
    "strip_ws", "folder_of", "greeting_name", "mtime_date", "name_of", "render",
    "split_rejects", "to_mb", "to_pk", "to_ts", "LOCAL_ZONE", "run_date", "run_date_text",
    "stamp", "to_local", "utc_wall", "weekday0",
]
