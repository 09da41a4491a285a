from tidemark.functions.containment import contains
from tidemark.functions.instants import from_micros, instant, iso_instant, later_of, quoted_iso, start_of_day
from tidemark.functions.members import member_text, member_texts, refresh_instant, typed, usable_key

__all__ = [
    "contains",
    "from_micros",
    "instant",
    "iso_instant",
    "later_of",
    "member_text",
    "member_texts",
    "quoted_iso",
    "refresh_instant",
    "start_of_day",
    "typed",
    "usable_key",
]
