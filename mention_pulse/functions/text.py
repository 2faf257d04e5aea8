"""Tag extraction, text cleaning and record status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide what a tag is and what cleaning removes. The classes
# hold a literal pipe on purpose. Tags keep letters and digits of any script; the cleaning steps
# are ASCII only.
TAG_PATTERN = r"[#|$]([\p{L}\p{N}_]+)"
DOTTED_TAG_PATTERN = r"[#|$]([\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)?)"
URL_TO_LAST_SPACE = r"(http.+) "
URL_TOKEN = r"https?://\S+"
TAG_OR_HANDLE = r"[@|#|$]\w+"
PLAIN_RUN = r"[a-zA-Z0-9-]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tags_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.array().cast("array<string>"))


def extract_tags(text: Column | str, dotted: bool = False) -> Column:
    """Upper-cased distinct tags of a text, in order of first use, without their # or $."""
    pattern = DOTTED_TAG_PATTERN if dotted else TAG_PATTERN
    found = F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, F.upper))


def all_tags(own: Column | str, parents: Column | str) -> Column:
    """Own tags followed by the parent's; a missing list counts as empty."""
    return F.concat(_tags_or_empty(own), _tags_or_empty(parents))


def union_tags(own: Column | str, parents: Column | str) -> Column:
    """Distinct tags of a post and its parent."""
    return F.array_union(_tags_or_empty(own), _tags_or_empty(parents))


def clean_text(text: Column | str, url_mode: str = "greedy") -> Column:
    """Text without URLs, tags, handles and signs, its words parted by single spaces.

    Turning every other sign into a space, runs of spaces into one, and trimming leaves just the
    plain runs parted by single spaces, so they are picked out and joined, in one pass.
    For URLs, 'greedy' removes from the first `http` of a line to the line's last space; 'token'
    removes each URL alone.
    """
    if url_mode not in ("greedy", "token"):
        raise ValueError(f"url_mode {url_mode!r} is neither 'greedy' nor 'token'")
    out = F.regexp_replace(_col(text), URL_TO_LAST_SPACE if url_mode == "greedy" else URL_TOKEN, " ")
    out = F.regexp_replace(out, TAG_OR_HANDLE, "")
    return F.array_join(F.regexp_extract_all(out, F.lit(PLAIN_RUN), F.lit(0)), " ")


def prefix_key(clean: Column | str, size: int = 25) -> Column:
    """Lower-cased start of a cleaned text: posts sharing it are taken for copies."""
    return F.lower(F.substring(_col(clean), 1, size))


def label(total: Column | str) -> Column:
    """POSITIVE, NEGATIVE or NEUTRAL by the sign of a score; null stays null."""
    total = _col(total)
    return F.when(total > 0, "POSITIVE").when(total < 0, "NEGATIVE").when(total == 0, "NEUTRAL")


def has_word(text: Column | str, words: Sequence[str]) -> Column:
    """Whether a text holds one of the words, whole and in any case."""
    inner = "|".join(words)
    return F.lower(_col(text)).rlike(rf"(^|[^a-z0-9_])({inner})([^a-z0-9_]|$)")
