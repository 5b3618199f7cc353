"""Application-log operators: bad records, the five-way split, flattening, page filters (F7-F11, R5-R8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart import schemas
from streammart.functions import explode_words, is_blank, not_blank, parsed_once


def drop_tombstones(raw: DataFrame) -> DataFrame:
    """Without the NULL and empty messages an upsert topic contains."""
    return raw.filter(not_blank("value"))


def tag_bad_records(raw: DataFrame, schema: str = schemas.APP_LOG) -> DataFrame:
    """``record`` is the typed row, or NULL where ``value`` is not such an object."""
    fields = T.StructType.fromDDL(schema).names
    ok = F.col("_p").isNotNull() & F.col("_p._bad").isNull()
    record = F.when(ok, F.struct(*[F.col(f"_p.{c}").alias(c) for c in fields]))
    return raw.select("value", parsed_once("value", schema).alias("_p")).select(
        "value", record.alias("record")
    )


def split_bad_records(
    raw: DataFrame, schema: str = schemas.APP_LOG
) -> tuple[DataFrame, DataFrame]:
    """(typed records, texts that could not be read). NULL messages are in neither."""
    tagged = tag_bad_records(raw.filter(F.col("value").isNotNull()), schema)
    good = tagged.filter("record is not null").select("record.*")
    return good, tagged.filter("record is null").select("value")


def explode_displays(logs: DataFrame) -> DataFrame:
    """One row per exposure, with the record's ``common`` and ``ts``."""
    return logs.select("common", "ts", F.explode("displays").alias("display"))


def explode_actions(logs: DataFrame) -> DataFrame:
    """One row per action; ``ts`` is the action's own time."""
    return logs.select("common", F.explode("actions").alias("action")).select(
        "common", F.col("action.ts").alias("ts"), "action"
    )


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """The five outputs of one parsed log.

    A record with ``err`` also continues below. A start record yields nothing else. What remains is
    a page view, without the parts already sent elsewhere.
    """
    not_start = logs.filter("start is null")
    return {
        "err": logs.filter("err is not null").select("common", "ts", "err"),
        "start": logs.filter("start is not null").select("common", "ts", "start"),
        "display": explode_displays(not_start),
        "action": explode_actions(not_start),
        "page": not_start.filter("page is not null").select("common", "ts", "page"),
    }


def search_keywords(pages: DataFrame) -> DataFrame:
    """Keyword searches: ``keyword`` and ``et``."""
    return pages.filter(
        F.col("page.last_page_id").isin("search", "home")
        & F.col("page.page_id").isNotNull()
        & (F.col("page.item_type") == "keyword")
        & F.col("page.item").isNotNull()
    ).select(F.col("page.item").alias("keyword"), "et")


def lateral_split_words(df: DataFrame, phrase: str = "keyword", segmenter=None) -> DataFrame:
    """One row per distinct word of a phrase, the other columns repeated."""
    return explode_words(df, phrase, "word", segmenter).drop(phrase)


def home_and_detail(pages: DataFrame) -> DataFrame:
    """Views of the home page and of product pages."""
    return pages.filter(F.col("page.page_id").isin("home", "good_detail"))


def logins(pages: DataFrame) -> DataFrame:
    """Signed-in page views that open a session: no previous page, or the login page."""
    return pages.filter(
        not_blank("common.uid")
        & (is_blank("page.last_page_id") | (F.col("page.last_page_id") == "login"))
    )
