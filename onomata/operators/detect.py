"""Dictionary detection: which dictionary names occur in which posts.

A post matches a dictionary line when the line's key is one of the post's
distinct terms, so a name counts at most once per post and line (a document
frequency), and a name listed twice matches twice.

``match="token"``: terms are lower-cased whitespace tokens; punctuation stays
on the token and a name with a space never matches.
``match="phrase"``: terms are runs of words with edge punctuation removed
(except ``+`` and ``#``), of the lengths that occur in the dictionary.

Filters. Terms are tested in-row before any of them is joined or shuffled: a
short dictionary's keys are a literal set, a longer one has a Bloom filter over
its keys, built by one aggregate (``plans/filters.py``). What the join gets to
see is close to the matches, whatever the dictionary's size. In phrase mode,
where keys have more than a few lengths or there is no filter over them, an
index by first word says which lengths of phrases may begin at a word, so only
these are built, in one pass over the post's words.

Join plan. The dictionary is measured first (one small aggregate). Within the
broadcast bound it is broadcast and each task probes its own posts: no
shuffle of posts, and only matched rows reach the aggregation. Past the bound
the join shuffles on the term:

* counts are pre-aggregated per term before the exchange: a hot term arrives
  as one row per map task instead of one per post;
* per-post mentions need every post's row. The terms that more posts have than
  a task's fair share are found by a frequent-items sketch over all of them;
  their rows are dealt to several tasks, and the dictionary's lines for them
  are repeated there (``plans/skew.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import combined_text, indexed_phrases, matching_set, phrase_key, phrase_set_of_words, phrase_words, word_tokens
from ..plans.filters import FirstWordIndex, KeyFilter, has_length
from ..plans.skew import join_with_salts
from ..plans.strategy import DictionaryShape, choose_join, literal_keys, measure_dictionary, shared_dir, stage_table, remove_table

MATCH_MODES = ("token", "phrase")
# Lengths of phrases up to which all of them are built where a filter over the keys tests them.
FEW_LENGTHS = 3


def key_dictionary(dictionary: DataFrame, match: str = "token") -> DataFrame:
    """``(entity_type, entity_name, match_key)``; names with an empty key are dropped."""
    if match not in MATCH_MODES:
        raise ValueError(f"unknown match mode {match!r}; use one of {MATCH_MODES}")
    name = F.col("entity_name")
    key = F.lower(name) if match == "token" else phrase_key(name)
    # Null keys are not unequal to "" either; the key is written once here, as a filter computes it each time.
    return dictionary.select("entity_type", "entity_name", key.alias("match_key")).filter(F.col("match_key") != "")


def post_terms(
    posts: DataFrame,
    id_cols: Sequence[str],
    match: str = "token",
    max_words: int = 1,
    keys: tuple[str, ...] | None = None,
    key_filter: KeyFilter | None = None,
    index: FirstWordIndex | None = None,
    lengths: Sequence[int] | None = None,
) -> DataFrame:
    """``(id_cols..., term)``: each distinct term of each post once.

    The empty token of a text with blanks at its ends is no term: no name has
    an empty key. In phrase mode an ``index`` of the dictionary and the
    ``lengths`` of its keys limit the phrases built to those that may match;
    without it every phrase of these lengths (of 1..max_words words without
    them) is built. With ``keys`` (a
    short dictionary's) only these terms are left, with a ``key_filter`` these
    and few others.
    """
    text = combined_text("title", "selftext")
    if match == "token":
        tokens = word_tokens(text)
        if keys is None:
            tokens = F.array_remove(tokens, "")
        terms = posts.select(*id_cols, F.explode(matching_set(tokens, keys)).alias("term"))
        return terms.where(key_filter.may_have(F.col("term"), key_filter.bits())) if key_filter else terms
    # Materialise the word array once; the phrases then slice a column
    # instead of re-splitting the text for every position.
    words = posts.select(*id_cols, phrase_words(text).alias("_words"))
    # A subquery cannot be written inside a lambda, so the index's array is
    # named first, in a projection of its own: the optimizer puts it back
    # into the lambda, and no row carries it. (The size keeps that projection
    # apart from the words: they are used twice and costly.)
    arrays = [index.bits().alias("_index")] if index is not None else []
    held = words.select(*id_cols, "_words", F.size("_words").alias("_size"), *arrays)
    if index is None:
        phrases = phrase_set_of_words(F.col("_words"), max_words, lengths, keys=keys)
    else:
        at = lambda w: index.lengths_at(w, F.col("_index"))
        phrases = matching_set(indexed_phrases(F.col("_words"), F.col("_size"), F.array(*map(F.lit, lengths)), at, has_length), keys)
    found = held.select(*id_cols, phrases.alias("_terms"))
    # For a plain explode the optimizer adds a filter on the array's size, and
    # with it computes all of the above again, the words once per phrase.
    terms = found.select(*id_cols, F.explode_outer("_terms").alias("term")).where(F.col("term").isNotNull())
    # Tested as rows, in generated code; a lambda over the array is interpreted.
    return terms.where(key_filter.may_have(F.col("term"), key_filter.bits())) if key_filter else terms


class Detection:
    """Keyed dictionary, its measured shape, its in-row filters and the chosen join strategy.

    The keyed dictionary is read for its shape, the index, the filter and the join. With ``stage_keys`` (for a long one,
    or one that is costly to compute) it is computed once and staged where there is a shared folder, until ``release``.
    """

    def __init__(self, dictionary: DataFrame, match: str = "token", strategy: str = "auto", stage_keys: bool = False):
        self.match = match
        self._staged: list[str] = []
        self.keyed = key_dictionary(dictionary, match)
        if stage_keys:
            self.keyed = self._once(self.keyed, "keys")
        self.shape: DictionaryShape = measure_dictionary(self.keyed)
        self.strategy = choose_join(self.shape, strategy)
        # Terms are filtered in-row before the join: by the keys themselves, or by a filter over them.
        self.keys = literal_keys(self.keyed, self.shape)
        useful = self.keys is None and KeyFilter.useful(self.shape.rows)
        self.key_filter = KeyFilter(self.keyed, "match_key", self.shape.rows) if useful else None
        # Phrase mode: only phrases are built of which the first word and the length occur together. For few lengths all
        # phrases are built: the filter over the keys tests them in less time than the index is asked for every word.
        few = self.key_filter is not None and len(self.shape.lengths) <= FEW_LENGTHS
        self.index = FirstWordIndex(self.keyed, "match_key", self.shape.rows) if match == "phrase" and not few else None

    @property
    def max_words(self) -> int:
        return self.shape.max_words if self.match == "phrase" else 1

    def terms(self, posts: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
        """``(id_cols..., term)``: the terms that the join gets to see."""
        return post_terms(posts, id_cols, self.match, self.max_words, self.keys, self.key_filter, self.index, self.shape.lengths)

    def _once(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows that are read several times: staged where there is a shared folder, so that they are computed once."""
        try:
            shared_dir(rows.sparkSession)
        except ValueError:
            return rows
        rows, path = stage_table(rows, name)
        self._staged.append(path)
        return rows

    def release(self) -> None:
        """Delete the staged tables, when the results have been read."""
        while self._staged:
            remove_table(self.keyed.sparkSession, self._staged.pop())

    def mentions(self, posts: DataFrame, id_cols: Sequence[str] = ("post_id",)) -> DataFrame:
        """One row per (post, matching dictionary line): ``(id_cols..., entity_type, entity_name)``."""
        lines = self.keyed.withColumnRenamed("match_key", "term")
        if self.strategy == "broadcast":
            joined = self.terms(posts, id_cols).join(F.broadcast(lines), "term", "inner")
        else:
            # A shuffled hash join: hash the dictionary's partitions, stream
            # the terms (no sort of the large side). Frequent terms are salted.
            # Terms are read for the sketch and for the join; what is staged is about as large as the result.
            terms = self._once(self.terms(posts, id_cols), "terms")
            spread = [F.col(c) for c in id_cols] or [F.col("term")]
            joined = join_with_salts(terms, lines, "term", spread, hint="shuffle_hash")
        return joined.select(*id_cols, "entity_type", "entity_name")

    def counts(self, posts: DataFrame) -> DataFrame:
        """``(entity_type, entity_name, n)``: posts mentioning each name, times its multiplicity."""
        if self.strategy == "broadcast":
            return count_entities(self.mentions(posts, ()))
        # Wide dictionary: document frequency per term first (partial aggregation
        # collapses hot terms map-side), then a vocabulary-sized join.
        term_df = self.terms(posts).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        lines = self.keyed.groupBy("match_key", "entity_type", "entity_name").agg(F.count(F.lit(1)).alias("mult"))
        joined = term_df.join(lines, F.col("term") == F.col("match_key"), "inner")
        return joined.groupBy("entity_type", "entity_name").agg(
            F.sum(F.col("df") * F.col("mult")).cast("bigint").alias("n")
        )


def detect_entities(
    posts: DataFrame,
    dictionary: DataFrame,
    match: str = "token",
    strategy: str = "auto",
    id_cols: Sequence[str] = ("post_id",),
) -> DataFrame:
    """Mentions ``(id_cols..., entity_type, entity_name)`` of dictionary names in posts."""
    return Detection(dictionary, match, strategy).mentions(posts, id_cols)


def count_entities(mentions: DataFrame) -> DataFrame:
    """``(entity_type, entity_name, n)`` from mentions; partial + final hash aggregate."""
    return mentions.groupBy("entity_type", "entity_name").agg(F.count(F.lit(1)).alias("n"))


def entity_counts(posts: DataFrame, dictionary: DataFrame, match: str = "token", strategy: str = "auto") -> DataFrame:
    """Counts straight from posts, with the plan chosen from the dictionary's size."""
    return Detection(dictionary, match, strategy).counts(posts)
