"""Login attributes split into good rows and rejected ones, by the reason, as rows that one can repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dormouse.defaults import LAST_AUTH_ATTRIBUTE, LAST_LOGIN_ATTRIBUTE
from dormouse.functions.time import FIRST_MILLIS, LAST_MILLIS, millis_text_to_timestamp

GOOD, EMPTY, NO_NUMBER, NO_TIME = "good", "empty", "not_a_number", "out_of_range"
_ROW = ("user_id", "directory_id", "attribute_name", "attribute_value")
_REASON = "reason"


def judged_values(attributes: DataFrame) -> DataFrame:
    """The attribute rows with ``reason``: ``good``, or why a login value cannot be read as a time.

    Values that are absent, and attributes that are no logins, are good. What is no number may be
    ``empty`` or blank, or ``not_a_number``; a number beyond the years 1 to 9999 is ``out_of_range``.
    """
    value = F.col("attribute_value")
    is_login = F.coalesce(
        F.col("attribute_name").isin(LAST_LOGIN_ATTRIBUTE, LAST_AUTH_ATTRIBUTE), F.lit(False)
    )
    # Numbers with too many digits for a decimal are numbers all the same.
    number = value.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    beyond = finite & ((number < FIRST_MILLIS) | (number > LAST_MILLIS))
    reason = (
        F.when(~is_login | value.isNull() | millis_text_to_timestamp(value).isNotNull(), F.lit(GOOD))
        .when(F.trim(value) == "", F.lit(EMPTY))
        .when(beyond, F.lit(NO_TIME))
        .otherwise(F.lit(NO_NUMBER))
    )
    return attributes.withColumn(_REASON, reason)


def rejected_values(attributes: DataFrame) -> DataFrame:
    """The login values that cannot be read, one row each, with the reason."""
    return judged_values(attributes).filter(F.col(_REASON) != GOOD).select(*_ROW, _REASON)


def write_split(attributes: DataFrame, path: str) -> None:
    """Writes good and rejected rows in one pass over the attributes, a folder for each reason.

    Nothing is shuffled: every task writes its rows to the folders of their reasons.
    """
    judged_values(attributes).write.partitionBy(_REASON).mode("errorifexists").parquet(path)


def good_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that are read as they are; only their folder is."""
    return _split(spark, path).filter(F.col(_REASON) == GOOD).drop(_REASON)


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    return _split(spark, path).filter(F.col(_REASON) != GOOD).select(*_ROW, _REASON)


def _split(spark: SparkSession, path: str) -> DataFrame:
    schema = "user_id long, directory_id long, attribute_name string, attribute_value string"
    return spark.read.schema(f"{schema}, {_REASON} string").parquet(path)
