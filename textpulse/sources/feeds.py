"""Feeds landed as JSON text: encyclopedia changes and tweet search pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse import rules, schemas
from textpulse.functions import dates, payload, text


def parse_changes(events: DataFrame, value: str = "value") -> DataFrame:
    return events.select("*", payload.decode(value, schemas.WIKI_CHANGE))


def is_english_edit() -> Column:
    """An edit on the English server with a comment and a title (which may be '')."""
    return (
        (F.col("server_name") == rules.WIKI_SERVER)
        & (F.col("type") == "edit")
        & (F.col("comment") != "")
        & F.col("title").isNotNull()
    )


def is_watched(watch_list: Sequence[str] = rules.WATCH_LIST) -> Column:
    return text.contains_any(text.lowered_pair("title", "comment"), watch_list)


def wiki_messages(
    changes: DataFrame, run_ts: str, watch_list: Sequence[str] = rules.WATCH_LIST
) -> DataFrame:
    return changes.where(is_english_edit()).where(is_watched(watch_list)).select(
        F.lit(rules.SOURCE_WIKI).alias("source"),
        text.article_line("title", "comment").alias("text"),
        dates.message_time(run_ts).alias("created_at"),
    )


def explode_pages(pages: DataFrame, value: str = "value") -> DataFrame:
    """One row per tweet of a search page, with its place on the page."""
    tweets = F.from_json(value, schemas.TWEET_PAGE)["tweets"]
    kept = [c for c in pages.columns if c != value]
    return pages.select(*kept, F.posexplode(tweets).alias("place", "tweet")).select(
        *kept, "place", "tweet.*"
    )


def search_messages(pages: DataFrame, run_ts: str, value: str = "value") -> DataFrame:
    found = explode_pages(pages, value).select(
        F.lit(rules.SOURCE_TWEETS_LIVE).alias("source"),
        text.first_nonempty("text", "full_text").alias("text"),
        dates.message_time(run_ts).alias("created_at"),
    )
    return found.where(F.col("text") != "")


def search(
    tweets: DataFrame,
    order: Sequence[Column],
    words: Sequence[str] = rules.SEARCH_WORDS,
    language: str = rules.SEARCH_LANGUAGE,
    page: int = rules.SEARCH_PAGE,
) -> DataFrame:
    """First page of the tweets in a language that hold any of the words."""
    found = text.words(text.clean_for_scoring("text"))
    wanted = (F.col("lang") == language) & text.any_word_of(found, words)
    return tweets.where(wanted).orderBy(*order).limit(page)


def all_messages(*feeds: DataFrame) -> DataFrame:
    """Bag union of the producers' messages."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged
