"""The tracker queries under the names that SQL users read them by."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame

from dormouse.plans.dormancy import dormant_accounts, dormant_external, licensed_accounts

# View names.
ACTIVE_VIEW = "active_users"
DORMANT_VIEW = "inactive_users_all"
EXTERNAL_VIEW = "inactive_users"


def publish_views(
    tables: Mapping[str, DataFrame],
    email_suffix: str,
    as_of: datetime | str | Column | None = None,
) -> None:
    """Register the three views in the session of the tables.

    Without ``as_of`` they are evaluated at the time of each read.
    """
    dormant = dormant_accounts(tables, as_of)
    licensed_accounts(tables).createOrReplaceTempView(ACTIVE_VIEW)
    dormant.createOrReplaceTempView(DORMANT_VIEW)
    dormant_external(dormant, email_suffix).createOrReplaceTempView(EXTERNAL_VIEW)
