"""Caption parsing and name scrubbing (T1, T2) as built-in column expressions.

A caption is cut into pieces at "newline, optional space, one or more dots,
optional space, newline".  Piece 1 is the caption text.  Among the later
pieces, the last one holding a ``#`` but no ``#repost`` (any case) gives the
hashtags, the last one holding ``#repost`` gives the repost credit.  Both have
``.``, ``,`` and newlines removed and surrounding white space stripped; the
credit also loses the literal ``#Repost `` (case as written).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the studied behaviour).
CAPTION_SEPARATOR = "\n ?\\.+ ?\n"
QUOTE_CHARS = "'\""
REMOVED_CHARS = ".,\n"
REPOST_MARK = "#repost"
REPOST_LITERAL = "#Repost "


def scrub_quotes(c: Column) -> Column:
    """Each single or double quote becomes one space; null stays null."""
    return F.translate(c, QUOTE_CHARS, " " * len(QUOTE_CHARS))


def strip_ws(c: Column) -> Column:
    r"""T2d: strip white space at both ends as Python's ``str.strip`` does.

    ``trim`` removes spaces only; Java's Unicode ``\s`` lacks the four
    separators U+001C-U+001F that ``str.strip`` also removes.
    """
    return F.regexp_replace(c, r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def caption_pieces(c: Column) -> Column:
    """All pieces, trailing empty pieces kept (limit -1)."""
    return F.split(c, CAPTION_SEPARATOR, -1)


def _last_tail_piece(pieces: Column, pred) -> Column:
    tail = F.filter(pieces, lambda x, i: (i > 0) & pred(x))
    return F.try_element_at(tail, F.lit(-1))


def caption_hashtags(pieces: Column) -> Column:
    """Last later piece with ``#`` and without ``#repost``; default ''."""
    piece = _last_tail_piece(
        pieces, lambda x: (F.instr(x, "#") > 0) & ~F.lower(x).contains(REPOST_MARK)
    )
    return F.coalesce(strip_ws(F.translate(piece, REMOVED_CHARS, "")), F.lit(""))


def caption_repost(pieces: Column) -> Column:
    """Last later piece containing ``#repost`` in any case; default ''."""
    piece = _last_tail_piece(pieces, lambda x: F.lower(x).contains(REPOST_MARK))
    cleaned = F.replace(F.translate(piece, REMOVED_CHARS, ""), F.lit(REPOST_LITERAL), F.lit(""))
    return F.coalesce(strip_ws(cleaned), F.lit(""))


def parse_caption(c: Column) -> Column:
    """Struct (caption_text, hashtags, repost) of a caption column."""
    pieces = caption_pieces(c)
    return F.struct(
        F.element_at(pieces, 1).alias("caption_text"),
        caption_hashtags(pieces).alias("hashtags"),
        caption_repost(pieces).alias("repost"),
    )


def with_caption_parts(df: DataFrame, caption: str, pieces: str = "_pieces") -> DataFrame:
    """``df`` with the split pieces of ``caption`` as a column, split once per row.

    Inline, the split would run once per derived field: Catalyst does not
    merge a projection that would repeat an expensive expression, so giving
    the pieces their own projection keeps it to one regex split.
    """
    return df.withColumn(pieces, caption_pieces(F.col(caption)))


def caption_fields(pieces: str = "_pieces") -> list[Column]:
    """caption_text, hashtags, repost from a pieces column."""
    k = F.col(pieces)
    return [F.element_at(k, 1).alias("caption_text"), caption_hashtags(k).alias("hashtags"),
            caption_repost(k).alias("repost")]
