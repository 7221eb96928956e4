"""Text functions as column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java pattern (Unicode white space and four separators), and the
# subset at which str.splitlines() breaks; predefined classes match fastest.
_SPACES = r"(?U)[\s\x1c-\x1f]+"
_LINE_BREAK = r"[\v\x1c-\x1e]"


def strip(text: Column) -> Column:
    """Trim every Unicode space at both ends (Spark's trim knows U+0020 only)."""
    return F.btrim(text, F.lit(SPACES))


def words(text: Column, limit: int | None = None) -> Column:
    """Words between whitespace; with `limit`, splitting stops after the first words."""
    if limit is None:
        return F.array_remove(F.split(text, _SPACES, -1), "")
    # One extra part for a blank before the first word, one for the unsplit rest.
    parts = F.split(text, _SPACES, limit + 2)
    return F.slice(F.array_remove(parts, ""), 1, limit)


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def word_prefix(text: Column, num_words: int = 300) -> Column:
    """First words by whitespace; runs of whitespace collapse to one blank."""
    return F.array_join(words(text, num_words), " ")


def word_prefix_by_space(text: Column, num_words: int = 2000) -> Column:
    """First words by single blank: line breaks stay inside words, empty words count."""
    return F.substring_index(text, " ", num_words)


def word_prefix_by_space_stripped(text: Column, num_words: int = 300) -> Column:
    return word_prefix_by_space(strip(text), num_words)


def char_prefix(text: Column, num_chars: int = 600) -> Column:
    """First code points."""
    return F.substring(text, 1, num_chars)


def normalize_lines(text: Column) -> Column:
    """Trim every line, drop blank lines, join the rest with one line feed."""
    lines = F.transform(F.split(text, _LINE_BREAK, -1), strip)
    return F.array_join(F.array_remove(lines, ""), "\n")


def paragraphs(text: Column) -> Column:
    """Non-empty pieces between line feeds, as an array."""
    return F.array_remove(F.split(text, "\n", -1), "")


def title_and_text(title: Column, text: Column, separator: str = " ") -> Column:
    """Null if either side is null."""
    return F.concat(title, F.lit(separator), text)


def decode_base64(text: Column) -> Column:
    return F.decode(F.unbase64(text), "UTF-8")


def iso_timestamp(ts: Column) -> Column:
    """ISO text; microseconds only where there are any."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(full.endswith(".000000"), F.substring(full, 1, 19)).otherwise(full)
