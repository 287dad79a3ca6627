"""When each account becomes dormant, kept by day, so that a daily run reads the days since the last one only."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dormouse.defaults import EXEMPT_GROUP, TRACKER_MONTHS
from dormouse.functions.time import first_after_months, instant, months_before
from dormouse.operators import activity, identity
from dormouse.plans.dormancy import canonical_eligible, listed_columns
from dormouse.session import require_utc

# Sign of life of any kind that the dormancy rule looks at.
_SIGNS = ("created_date", "lastlogin", "lastauth", "lastassign", "lastreactivate")
_INDEX_COLUMNS = ("last_active", "expires_at", "expires_on")


def account_expiries(
    tables: Mapping[str, DataFrame],
    months: int = TRACKER_MONTHS,
    exempt_group: str = EXEMPT_GROUP,
    lenient: bool = False,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Everybody whom the dormancy rule lists sooner or later, with the instant it first does.

    ``last_active`` is the latest sign of life, and an account is dormant while it is before the
    cut. ``expires_at`` is the first instant at which it is. As the cut is clamped to the end of
    a month, it may fall back at the midnight after, so an account that expires late on the last
    day of a short month is not dormant again for the same hours of the days that follow. An account
    without a creation date never expires. Columns are those of ``dormant_accounts`` and these.
    """
    require_utc(tables["account"])
    exempt = identity.exempt_accounts(
        tables["account"], tables["membership"], tables["grp"], exempt_group
    )
    recent = activity.activity_by_name(tables) if recent is None else recent
    people = identity.not_exempt(
        canonical_eligible(tables).filter(F.col("created_date").isNotNull()), exempt
    ).join(recent, "user_name", "left")
    signs = [F.col(name).cast("timestamp") for name in _SIGNS]
    people = activity.account_activity(people, tables["attrs"], lenient).withColumn(
        "last_active", F.greatest(*signs)
    )
    expiry = first_after_months(F.col("last_active"), months)
    return people.withColumn("expires_at", expiry).select(
        *listed_columns(), "last_active", "expires_at", F.col("expires_at").cast("date").alias("expires_on")
    )


def write_expiry_index(expiries: DataFrame, path: str, months: int = TRACKER_MONTHS) -> None:
    """Writes the accounts below ``path``, a folder for each day on which some of them expire.

    Rows of a day come together in files of the size that the session advises; a day with very many
    accounts, as after a migration, is split into several. The index of another period may lie beside.
    """
    dealt = expiries.hint("rebalance", "expires_on")
    dealt.write.partitionBy("expires_on").mode("errorifexists").parquet(_folder(path, months))


def expiry_index(spark: SparkSession, path: str, months: int = TRACKER_MONTHS) -> DataFrame:
    """The accounts of an index for the period; one that was never written is refused."""
    return spark.read.parquet(_folder(path, months))


def _folder(path: str, months: int) -> str:
    return f"{path}/months-{months}"


def dormant_at(
    expiries: DataFrame, as_of: datetime | str | Column | None = None, months: int = TRACKER_MONTHS
) -> DataFrame:
    """The accounts that the dormancy rule lists at an instant, unsorted; reads the days up to it."""
    return _listed(
        expiries.filter(
            (F.col("expires_on") <= instant(as_of).cast("date"))
            & (F.col("last_active") < months_before(as_of, months))
        )
    )


def newly_dormant(
    expiries: DataFrame,
    since: datetime | str | Column,
    as_of: datetime | str | Column | None = None,
    months: int = TRACKER_MONTHS,
) -> DataFrame:
    """The accounts that the dormancy rule lists at ``as_of`` but did not at ``since``, unsorted.

    Their latest sign of life is not before the cut of ``since``, so they expire from the day on
    which an account expires that was last active then. Only the days from there to ``as_of`` are
    read. ``months`` has to be the period that the expiries were made for.
    """
    cut = months_before(since, months)
    return _listed(
        expiries.filter(
            F.col("expires_on").between(
                first_after_months(cut, months).cast("date"), instant(as_of).cast("date")
            )
            & (F.col("last_active") >= cut)
            & (F.col("last_active") < months_before(as_of, months))
        )
    )


def _listed(expiries: DataFrame) -> DataFrame:
    return expiries.drop(*_INDEX_COLUMNS)
