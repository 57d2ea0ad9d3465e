"""Column expressions over text: chunking, cleaning, titles, statement checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results.
CHUNK_SIZE = 400
CHUNK_OVERLAP = 50
EXCERPT_CHARS = 400
PREVIEW_CHARS = 250
ROWS_JSON_CHARS = 3000
WRITE_KEYWORDS = (
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE", "CREATE", "GRANT", "REVOKE", "MERGE",
)
NO_STATEMENT = "No statement was given."
REFUSED = "Generated query failed safety check; refused to execute."

# Entities found in the page corpus; the ampersand comes last so that no entity is decoded twice.
ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_filled(c: Column | str) -> Column:
    """True when the text holds any non-space character, in the Unicode sense (``trim`` knows U+0020 only)."""
    return _col(c).rlike(r"(?U)\S")


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def chunk_text(c: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of overlapping character windows: window i starts at ``i * (size - overlap)``; blank ones go.

    The text is first cut into pieces of one step each in a single scan, and a window is then a few
    neighbouring pieces. ``substring(text, start, size)`` per window would walk the UTF-8 text from its
    beginning every time, which is quadratic in the length of the document.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("need size > 0 and 0 <= overlap < size")
    step = size - overlap
    following = -(-overlap // step)
    pieces = F.regexp_extract_all(_col(c), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    def windows(all_pieces: Column) -> Column:
        def window(piece: Column, i: Column) -> Column:
            if overlap == 0:
                return piece
            if following == 1:
                after = F.coalesce(F.get(all_pieces, i + 1), F.lit(""))
                return F.concat(piece, F.substring(after, 1, overlap))
            joined = F.array_join(F.slice(all_pieces, i + 1, F.lit(following + 1)), "")
            return F.substring(joined, 1, size)

        return F.filter(F.transform(all_pieces, window), is_filled)

    # One-element transform: binds the piece array to a variable, so the scan is not repeated per window.
    return F.flatten(F.transform(F.array(pieces), windows))


def first_line(c: Column | str) -> Column:
    """First line that is not blank, stripped; null when there is none. Reads no further than that line."""
    line = F.regexp_extract(_col(c), r"(?U)(\S[^\n]*)", 1)
    return F.nullif(F.regexp_replace(line, r"(?U)\s+$", ""), F.lit(""))


def one_line(c: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    """Preview: the first characters with line breaks shown as spaces."""
    return F.translate(F.substring(_col(c), 1, chars), "\n", " ")


def html_text(c: Column | str) -> Column:
    """Visible text of an HTML page: no scripts, styles, comments or tags; entities decoded; one space runs."""
    text = F.coalesce(_col(c), F.lit(""))
    text = F.regexp_replace(text, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return F.btrim(F.regexp_replace(text, r"\s+", " "), F.lit(" "))


def strip_fence(c: Column | str) -> Column:
    """A generated statement without its Markdown code fence."""
    bare = F.regexp_replace(_col(c), r"(?i)^```sql|```$", "")
    return F.btrim(bare, F.lit("` \n"))


def is_read_only(statement: Column | str) -> Column:
    """Statement starts with SELECT or WITH and names no write keyword anywhere as a whole word."""
    statement = _col(statement)
    keywords = "|".join(WRITE_KEYWORDS)
    return statement.rlike(r"(?i)^\s*(SELECT|WITH)\b") & ~statement.rlike(rf"(?i)\b({keywords})\b")


def guard_message(statement: Column | str) -> Column:
    """The refusal text for a statement that must not run, or is missing; null for a clean one."""
    statement = _col(statement)
    return F.when(statement.isNull(), F.lit(NO_STATEMENT)).when(~is_read_only(statement), F.lit(REFUSED))
