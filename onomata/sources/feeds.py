"""Feed bodies: attach landed JSON to subscriptions, decode them into posts.

Feeds are not downloaded inside tasks. Bodies are landed beforehand (files or
a table ``(url, page, body)``); one row is one downloaded page. A page is
all-or-nothing: one bad child discards every post of that page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import join_with_salts
from ..plans.strategy import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

# The body is read as text per child, which has no size limit; each child alone becomes a variant.
_BODY_SCHEMA = "data struct<children: array<string>>, _corrupt_record string"
# A larger child is read into strings instead of a variant, whose size has a limit.
VARIANT_MAX_BYTES = 16 * 1024 * 1024 - 1024
# Strings of JSON may have any length (Spark's default is 20 million characters).
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}
_FIELDS = ("title", "selftext", "id")


def _field(child: Column, name: str) -> Column:
    return F.variant_get(child, f"$.data.{name}", "variant")


def _missing(child: Column, name: str) -> Column:
    # SQL NULL only when the key is absent; a JSON null is a variant null.
    return _field(child, name).isNull()


def _not_scalar(child: Column, name: str) -> Column:
    return F.schema_of_variant(_field(child, name)).rlike("^(OBJECT|ARRAY)")


def _data_as(text: Column, kind: str) -> Column:
    """The fields of a child's data, each read as ``kind`` and null where it is of another kind."""
    return F.from_json(text, f"data struct<{', '.join(f'{name}: {kind}' for name in _FIELDS)}>", _ANY_LENGTH)["data"]


def _unique_keys(entries: Column) -> Column:
    return F.size(F.array_distinct(F.map_keys(entries))) == F.size(F.map_keys(entries))


def _large_child(text: Column) -> Column:
    """A child of any size read into strings; null where it is no object or it or its data repeats a key."""
    top = F.from_json(text, "map<string, string>", _ANY_LENGTH)
    own = F.from_json(text, "data map<string, string>", _ANY_LENGTH)["data"]
    return F.when(
        _unique_keys(top) & (own.isNull() | _unique_keys(own)),
        F.struct(own.alias("own"), _data_as(text, "map<string, string>").alias("objects"), _data_as(text, "array<string>").alias("arrays"), _data_as(text, "double").alias("numbers")),
    )


def _large_value(large: Column, name: str) -> Column:
    # Numbers are written as a variant writes them.
    text = large["own"][name]
    number = F.try_variant_get(F.try_parse_json(F.when(large["numbers"][name].isNotNull(), text)), "$", "string")
    return F.coalesce(number, text)


def read_child(text: Column) -> Column:
    """A child's JSON text as ``(small, large)``: a variant, or strings beyond a variant's size."""
    fits = F.octet_length(text) <= VARIANT_MAX_BYTES
    return F.struct(F.when(fits, F.try_parse_json(text)).alias("small"), F.when(~fits, _large_child(text)).alias("large"))


def _lacks(child: Column, name: str) -> Column:
    """Whether a child (of ``read_child``) is unreadable or has no such key."""
    small, large = child["small"], child["large"]
    has = F.coalesce(F.map_contains_key(large["own"], name), F.lit(False))
    return F.when(large.isNotNull(), ~has).otherwise(small.isNull() | _missing(small, name))


def _nested(child: Column, name: str) -> Column:
    small, large = child["small"], child["large"]
    return F.when(large.isNotNull(), large["objects"][name].isNotNull() | large["arrays"][name].isNotNull()).otherwise(_not_scalar(small, name))


def _value(child: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(child["small"], f"$.data.{name}", "string"), _large_value(child["large"], name))


def _is_json(body: Column) -> Column:
    # get_json_object refuses strings of over 20 million characters.
    readings = [F.from_json(body, kind, _ANY_LENGTH).isNotNull() for kind in ("map<string, string>", "array<string>")]
    return F.get_json_object(body, "$").isNotNull() | ((F.octet_length(body) > 20_000_000) & (readings[0] | readings[1]))


def feed_status_expr(body: Column, texts: Column, children: Column) -> Column:
    """Outcome of one body; tests run in the order of ``constants.FEED_STATUSES``.

    ``texts`` are the children as JSON text (null unless the body is JSON with a
    list of children), ``children`` the same read by ``read_child``. A child that
    is no readable object (a string, null, or an object that repeats a key) has
    no fields, so it counts as ``MISSING_FIELD``. Of a child too large for a
    variant, keys repeated below its data are not looked for.
    """
    return (
        F.when(body.isNull(), F.lit("FETCH_FAILED"))
        # Without a list of children: valid JSON of another shape, or no JSON at all.
        .when(texts.isNull() & ~_is_json(body), F.lit("BAD_JSON"))
        .when(texts.isNull(), F.lit("NO_CHILDREN"))
        .when(F.exists(children, lambda c: _lacks(c, "title") | _lacks(c, "selftext")), F.lit("MISSING_FIELD"))
        .when(F.exists(children, lambda c: _nested(c, "title") | _nested(c, "selftext")), F.lit("BAD_FIELD"))
        .when(F.size(children) == 0, F.lit("EMPTY"))
        .otherwise(F.lit("OK"))
    )


def fits_broadcast(subscriptions: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the list's measured rows and bytes are within the bound (one aggregate)."""
    size = F.sum(F.octet_length("name") + F.octet_length("url"))
    rows, text_bytes = subscriptions.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return rows <= max_rows and text_bytes <= max_bytes


def attach_feeds(subscriptions: DataFrame, landed: DataFrame, max_broadcast_subscriptions: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Valid subscriptions x landed pages on ``url``.

    Returns ``(name, url, page, body)``: one row per landed page, and one row with
    null page/body for a subscription with nothing landed (fetch failed).

    The landed side is the big one and one feed may own a third of its pages.
    The subscription list is broadcast when its measured rows and bytes allow,
    and landed pages are then not shuffled. A longer list joins by a shuffle on
    ``url``: a sketch over the landed urls (one pass over that column) finds the
    feeds with more pages than a task's fair share, their pages are dealt to
    several tasks and their subscriptions repeated there. Missing feeds come
    from an anti join against the distinct landed urls, which are aggregated
    partially before the exchange.
    """
    return fetched_feeds(subscriptions, landed, max_broadcast_subscriptions).unionByName(missing_feeds(subscriptions, landed))


def fetched_feeds(subscriptions: DataFrame, landed: DataFrame, max_broadcast_subscriptions: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The first part of ``attach_feeds``: a row per landed page of each subscription."""
    subs = subscriptions.select("name", "url")
    pages = landed.select("url", "page", "body")
    if fits_broadcast(subs, max_broadcast_subscriptions):
        fetched = pages.join(F.broadcast(subs), "url", "inner")
    else:
        fetched = join_with_salts(pages, subs, "url", [F.col("page"), F.octet_length("body")])
    return fetched.select("name", "url", "page", "body")


def missing_feeds(subscriptions: DataFrame, landed: DataFrame) -> DataFrame:
    """The second part of ``attach_feeds``: a row with null page and body per subscription with nothing landed."""
    failed = subscriptions.select("name", "url").join(landed.select("url").distinct(), "url", "left_anti")
    return failed.select("name", "url", F.lit(None).cast("bigint").alias("page"), F.lit(None).cast("string").alias("body"))


def parse_feeds(attached: DataFrame) -> DataFrame:
    """Decode every body once; one row per post, or one row per body without posts.

    Columns: ``name, url, page, status, n_children, child_pos, post_id, title,
    selftext``. ``child_pos`` is null on rows that carry no post. Numbers as a
    title become text; JSON null becomes null (dropped later by the post filter).
    A body and each of its children may be of any size.
    """
    # One projection per step so each body is parsed once: the later steps
    # reference the parsed value several times (status tests, children), and
    # Catalyst keeps a costly expression in its own projection when it is
    # referenced more than once rather than inlining it.
    body = F.from_json("body", _BODY_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record", **_ANY_LENGTH})
    with_body = attached.select("name", "url", "page", "body", body.alias("_j"))
    with_texts = with_body.select(
        "name", "url", "page", "body", F.when(F.col("_j._corrupt_record").isNull(), F.col("_j.data.children")).alias("texts")
    )
    with_children = with_texts.select(
        "name", "url", "page", "body", "texts", F.transform("texts", read_child).alias("children")
    )
    decoded = with_children.select(
        "name",
        "url",
        "page",
        feed_status_expr(F.col("body"), F.col("texts"), F.col("children")).alias("status"),
        "children",
    )
    ok_children = F.when(F.col("status") == "OK", F.col("children"))
    exploded = decoded.select(
        "name",
        "url",
        "page",
        "status",
        F.coalesce(F.size(ok_children), F.lit(0)).alias("n_children"),
        F.posexplode_outer(ok_children).alias("child_pos", "child"),
    )
    return exploded.select(
        "name",
        "url",
        "page",
        "status",
        "n_children",
        "child_pos",
        _value(F.col("child"), "id").alias("post_id"),
        _value(F.col("child"), "title").alias("title"),
        _value(F.col("child"), "selftext").alias("selftext"),
    )


def feed_posts(parsed: DataFrame) -> DataFrame:
    """Posts of the decoded feeds: ``(feed, url, page, post_id, title, selftext)``."""
    return parsed.filter(F.col("child_pos").isNotNull()).select(
        F.col("name").alias("feed"), "url", "page", "post_id", "title", "selftext"
    )


def feed_status(parsed: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row per body (and per skipped subscription): ``(name, url, page, status, n_posts)``."""
    per_body = parsed.filter(F.col("child_pos").isNull() | (F.col("child_pos") == 0)).select(
        "name", "url", "page", "status", F.col("n_children").cast("bigint").alias("n_posts")
    )
    if skipped is None:
        return per_body
    return per_body.unionByName(
        skipped.select(
            "name",
            "url",
            F.lit(None).cast("bigint").alias("page"),
            F.lit("SKIPPED").alias("status"),
            F.lit(0).cast("bigint").alias("n_posts"),
        )
    )


def page_summary(parsed: DataFrame) -> DataFrame:
    """The decoded pages reduced to ``(name, url, page, status, bodies)``; ``bodies`` counts equal pages that landed
    several times."""
    is_post = F.col("child_pos").isNotNull()
    return parsed.groupBy("name", "url", "page", "status").agg(F.count_if(~is_post | (F.col("child_pos") == 0)).alias("bodies"))


def parse_diagnostics(pages: DataFrame) -> DataFrame:
    """WARN rows, one per body, for those that failed to download or decode (from ``page_summary``)."""
    from ..constants import MSG_FETCH_FAILED, MSG_PARSE_FAILED

    bad = pages.filter(~F.col("status").isin("OK", "EMPTY")).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "bodies")))
    return bad.select(
        F.lit("WARN").alias("severity"),
        F.col("status").alias("code"),
        F.col("url").alias("subject"),
        F.when(F.col("status") == "FETCH_FAILED", F.format_string(MSG_FETCH_FAILED, F.col("name"), F.col("url")))
        .otherwise(F.format_string(MSG_PARSE_FAILED, F.col("name"), F.col("url")))
        .alias("message"),
    )


LANDED_SCHEMA = "url string, page bigint, body string"


def landed_json(reader):
    """A reader of landed pages, batch or streaming: same schema and options."""
    return reader.schema(LANDED_SCHEMA).option("mode", "PERMISSIVE").options(**_ANY_LENGTH)


def read_landed_pages(spark, path: str | list[str]) -> DataFrame:
    """Landed pages stored as JSON lines ``{"url", "page", "body"}`` (splittable, any size); paths, lists and globs."""
    return landed_json(spark.read).json(path)


def read_landed_bodies(spark, path: str | list[str], url_prefix: str = "") -> DataFrame:
    """Landed pages stored one raw body per file; ``url`` = prefix + file name, ``page`` = 0.

    Each file is read whole (one page of a feed, bounded by the source's page
    size); an unreadable or empty file becomes an empty body and decodes as
    ``BAD_JSON``.
    """
    raw = spark.read.option("wholetext", True).text(path)
    return raw.select(
        F.concat(F.lit(url_prefix), F.col("_metadata.file_name")).alias("url"),
        F.lit(0).cast("bigint").alias("page"),
        F.col("value").alias("body"),
    )
