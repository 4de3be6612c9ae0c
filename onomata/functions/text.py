"""Column expressions for post text (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex classes. ``\s`` in Java is ASCII whitespace only
# ([ \t\n\x0B\f\r]); NBSP is not a separator.
WHITESPACE_RUN = r"\s+"
# Java ``String.trim`` strips every char <= U+0020 at both ends. ``\z`` is the very end: ``$`` also matches before a
# final line terminator such as U+0085 or U+2028.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+\z"
# Any char above U+0020: the string is not blank after Java trim.
_NOT_BLANK = r"[^\x00-\x20]"
# ASCII punctuation except '+' and '#', which belong to names like C++ / C#.
_EDGE_PUNCT = r"^[\p{Punct}&&[^+#]]+|[\p{Punct}&&[^+#]]+\z"
# The same at the edges of every word of a text.
_WORD_EDGE_PUNCT = r"(?<!\S)[\p{Punct}&&[^+#]]+|[\p{Punct}&&[^+#]]+(?!\S)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: str | Column) -> Column:
    """Strip all chars <= U+0020 from both ends (Spark ``trim`` strips only spaces)."""
    return F.regexp_replace(_col(c), _JAVA_TRIM, "")


def is_not_blank(c: str | Column) -> Column:
    """True when something other than control chars / space remains; null for null."""
    return _col(c).rlike(_NOT_BLANK)


def combined_text(title: str | Column = "title", selftext: str | Column = "selftext") -> Column:
    """title + ' ' + selftext; null parts read as empty (unfiltered posts may hold nulls)."""
    return F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), F.coalesce(_col(selftext), F.lit("")))


def word_tokens(text: str | Column) -> Column:
    """Lower-cased whitespace tokens, in order, duplicates kept."""
    return F.split(F.lower(_col(text)), WHITESPACE_RUN)


def token_set(text: str | Column) -> Column:
    """Distinct lower-cased whitespace tokens of a text (row-local, no shuffle)."""
    return F.array_distinct(word_tokens(text))


def strip_edge_punct(c: str | Column) -> Column:
    """Remove leading/trailing ASCII punctuation other than '+' and '#'."""
    return F.regexp_replace(_col(c), _EDGE_PUNCT, "")


def phrase_words(text: str | Column) -> Column:
    """Ordered lower-case words with edge punctuation removed; empty words dropped.

    The whole text is stripped before it is split: one pass, where a lambda would run a regex for every word.
    """
    return F.array_remove(F.split(F.regexp_replace(F.lower(_col(text)), _WORD_EDGE_PUNCT, ""), WHITESPACE_RUN), "")


def phrase_key(name: str | Column) -> Column:
    """Normalised phrase for a dictionary name: its phrase words joined by one space."""
    return F.array_join(phrase_words(name), " ")


def ngrams(words: Column, n: int, first_words: list[str] | tuple[str, ...] | None = None) -> Column:
    """Contiguous n-word phrases of an ordered word array, joined by a space.

    With ``first_words``, only phrases starting with one of those words are
    built (a hash-set membership test per position).
    """
    size = F.size(words)
    starts = F.sequence(F.lit(1), size - F.lit(n - 1))
    if first_words is not None:
        starts = F.filter(starts, lambda i: F.element_at(words, i).isin(list(first_words)))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))


# array_intersect hashes its right-hand array for every row, so it is used only
# for short key lists; longer lists use IN, which Catalyst turns into a
# hash set built once per task.
_INTERSECT_MAX_KEYS = 100


def matching_set(terms: Column, keys: list[str] | tuple[str, ...] | None = None) -> Column:
    """Distinct terms; with ``keys``, only those among the keys."""
    if keys is None:
        return F.array_distinct(terms)
    if len(keys) <= _INTERSECT_MAX_KEYS:
        return F.array_intersect(terms, F.array(*[F.lit(k) for k in keys]).cast("array<string>"))
    return F.array_distinct(F.filter(terms, lambda t: t.isin(list(keys))))


def phrase_set_of_words(
    words: Column,
    max_words: int,
    lengths: list[int] | tuple[int, ...] | None = None,
    first_words: list[str] | tuple[str, ...] | None = None,
    keys: list[str] | tuple[str, ...] | None = None,
) -> Column:
    """Distinct phrases of 1..max_words words (or of the given ``lengths``) from an ordered word array.

    ``words`` should be a plain column reference: each n-gram slices it once per
    position, so an inline expression would be re-evaluated per position.
    """
    ns = sorted(set(lengths)) if lengths else list(range(1, max(1, max_words) + 1))
    parts = [words if n == 1 else ngrams(words, n, first_words) for n in ns]
    return matching_set(F.flatten(F.array(*parts)) if len(parts) > 1 else parts[0], keys)


def indexed_phrases(words: Column, size: Column, lengths: Column, lengths_at: Callable[[Column], Column], allows: Callable[[Column, Column], Column]) -> Column:
    """Phrases of an ordered array of ``size`` words that begin where an index allows it, of the lengths that it allows.

    ``lengths_at(word)`` is the index entry of a word (0 for none), ``allows(entry, n)`` whether phrases of n words may
    begin there; ``lengths`` are the lengths to try. One pass over the words, whatever the number of lengths; phrases
    that occur again are built again.
    """
    starts = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("at"), lengths_at(w).alias("entry"))), lambda s: s["entry"] != 0)

    def of(s: Column) -> Column:
        fitting = F.filter(lengths, lambda n: allows(s["entry"], n) & (s["at"] + n <= size))
        return F.transform(fitting, lambda n: F.array_join(F.slice(words, s["at"] + 1, n), " "))

    return F.flatten(F.transform(starts, of))


def post_length(title: str | Column = "title", selftext: str | Column = "selftext", utf16: bool = False) -> Column:
    """Characters of title plus selftext (the joining space is not counted).

    Code points by default; ``utf16=True`` counts UTF-16 units like Java ``String.length``.
    """
    if utf16:
        def units(c: Column) -> Column:
            return F.coalesce(F.octet_length(F.encode(c, "UTF-16BE")) / 2, F.lit(0)).cast("bigint")
    else:
        def units(c: Column) -> Column:
            return F.coalesce(F.length(c), F.lit(0)).cast("bigint")
    return units(_col(title)) + units(_col(selftext))


def describe(entity_type: str | Column = "entity_type", entity_name: str | Column = "entity_name") -> Column:
    """``[type] name``."""
    return F.concat(F.lit("["), _col(entity_type), F.lit("] "), _col(entity_name))


def first_line(text: str | Column) -> Column:
    """Text before the first newline (the whole text when there is none)."""
    return F.substring_index(_col(text), "\n", 1)


def after_first_line(text: str | Column) -> Column:
    """Text after the first newline; empty when there is none.

    Two-argument ``substr`` reads to the end without first counting the
    characters of the whole text (a length argument would cost a full pass).
    """
    t = _col(text)
    pos = F.instr(t, "\n")
    return F.when(pos > 0, F.substr(t, pos + 1)).otherwise(F.lit(""))
