"""Runs for spark-submit: find dormant accounts, record what to do, apply it; wiki and licence reports."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from dormouse.operators import activity_state, quarantine
from dormouse.plans.account_store import store_accounts, switch_off
from dormouse.plans.deactivation import accounts_after, deactivation_plan, observed, observed_summary
from dormouse.plans.dormancy import dormant_accounts, dormant_external, licensed_accounts
from dormouse.plans.expiry import account_expiries, dormant_at, expiry_index, newly_dormant, write_expiry_index
from dormouse.plans.login_rule import dormant_by_login_rule
from dormouse.plans.stored_views import store_views
from dormouse.plans.wiki import wiki_dormant
from dormouse.session import apply_settings, planned_bytes
from dormouse.sources.generations import published
from dormouse.sources.schemas import SOURCE_NAMES, TRACKER, WIKI
from dormouse.sources.tables import Split, Tables, from_catalog, from_jdbc, from_parquet
from dormouse.sources.writers import write_table

REPORTS = ("wiki", "licences")


def deactivate(
    tables: Tables, dormant: DataFrame, out: str, dry_run: bool, store: str | None = None
) -> DataFrame:
    """Write the names and the plan below ``out`` and, unless it is a dry run, the new account table.

    The plan is built from the names as written, and the account table from the
    plan as written, so that they agree. The account table has all columns of its
    source and its source's name, so that ``out`` can be opened like an export.
    With a ``store``, only the parts of it that change are written instead; it is made first where
    there is none. Returns the summary of the plan, counted while the plan was written.
    """
    spark = dormant.sparkSession
    names = write_table(dormant, f"{out}/names")
    plan, counts = observed(deactivation_plan(names, tables["account"], tables["directory"]))
    plan = write_table(plan, f"{out}/plan")
    if not dry_run and store:
        if published(spark, store) is None:
            store_accounts(tables.raw("account"), store)
        switch_off(spark, store, plan)
    elif not dry_run:
        after = accounts_after(tables.raw("account"), plan)
        write_table(after, f"{out}/{SOURCE_NAMES['account']}")
    return observed_summary(spark, counts)


def _split(text: str) -> tuple[str, Split]:
    """``table=column,lower,upper,partitions``; bounds are whole numbers or ISO times."""
    table, _, rest = text.partition("=")
    parts = rest.split(",")
    if not table or len(parts) != 4:
        raise argparse.ArgumentTypeError(f"{text!r} is not table=column,lower,upper,partitions")
    column, lower, upper, partitions = parts
    return table, Split(column, _bound(lower), _bound(upper), int(partitions))


def _bound(text: str) -> int | datetime:
    return int(text) if text.lstrip("-").isdigit() else datetime.fromisoformat(text)


def _property(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(description=__doc__)
    source = made.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="folder with one Parquet table per source table")
    source.add_argument("--database", help="catalog database with the source tables")
    source.add_argument("--jdbc", help="URL of a live database with the source tables")
    made.add_argument("--split", type=_split, action="append", default=[],
                      help="table=column,lower,upper,partitions, for a live database")
    made.add_argument("--small", action="append", default=[],
                      help="table of a live database that one task may read")
    made.add_argument("--property", type=_property, action="append", default=[],
                      help="key=value for the connection to a live database")
    made.add_argument("--out", help="new folder for the results")
    made.add_argument("--rule", choices=["activity", "login", *REPORTS], default="activity")
    made.add_argument("--strict", action="store_true", help="wiki: judge page edits by themselves")
    made.add_argument("--store-views", action="store_true",
                      help="only create the views of the tracker in the catalog database")
    made.add_argument("--email-suffix", help="addresses that are never deactivated")
    made.add_argument("--as-of", help="ISO date and time; now by default")
    made.add_argument("--shuffle-bytes", type=int, help="size of the largest shuffle")
    made.add_argument("--input-bytes", type=int, help="size of the largest table")
    made.add_argument("--apply", action="store_true", help="also write the account table")
    made.add_argument("--account-store", help="with --apply: folder of the account table in parts, "
                      "of which only those that change are written")
    made.add_argument("--activity-state", help="folder of the latest activity per key, "
                      "to which only events since the last run are added")
    made.add_argument("--expiry-index", help="folder of the accounts by the day they become dormant; "
                      "written, or read with --since")
    made.add_argument("--since", help="ISO date and time: only accounts that were not dormant then")
    made.add_argument("--quarantine", action="store_true",
                      help="write login values that are no times to a folder of their own and go on without them")
    return made


def main(arguments: Sequence[str] | None = None) -> None:
    made = parser()
    options = made.parse_args(arguments)
    if (options.rule == "activity" or options.store_views) and not options.email_suffix:
        made.error("the activity rule and the views need --email-suffix")
    if options.store_views and not options.database:
        made.error("views are stored in a --database")
    if options.since and not options.expiry_index:
        made.error("--since reads an --expiry-index")
    if not options.store_views and not options.out:
        made.error("results need --out")

    spark = SparkSession.builder.appName("account dormancy").getOrCreate()
    apply_settings(spark, options.shuffle_bytes, options.input_bytes)
    if options.store_views:
        store_views(spark, options.database, options.email_suffix)
        return
    tables = _open(spark, options, WIKI if options.rule == "wiki" else TRACKER)

    as_of = options.as_of or datetime.now(timezone.utc)
    result = _dormant(tables, options, as_of)
    if options.shuffle_bytes is None:
        # The tables that the result reads, as far as they are opened by now.
        apply_settings(spark, planned_bytes(tables.opened().values()), options.input_bytes)
    if options.rule in REPORTS:
        write_table(result, f"{options.out}/report")
    else:
        deactivate(
            tables, result, options.out, dry_run=not options.apply, store=options.account_store
        ).show(truncate=False)


def _open(spark: SparkSession, options: argparse.Namespace, schemas: Mapping) -> Tables:
    if options.parquet:
        return from_parquet(spark, options.parquet, schemas)
    if options.database:
        return from_catalog(spark, options.database, schemas)
    return from_jdbc(
        spark, options.jdbc, schemas, dict(options.split), dict(options.property),
        small=options.small,
    )


def _dormant(
    tables: Mapping[str, DataFrame], options: argparse.Namespace, as_of: datetime | str
) -> DataFrame:
    if options.rule == "wiki":
        return wiki_dormant(tables, as_of, strict=options.strict, ordered=False)
    if options.rule == "licences":
        return licensed_accounts(tables)
    if options.rule == "login":
        return dormant_by_login_rule(tables, as_of)
    return dormant_external(_without_activity(tables, options, as_of), options.email_suffix)


def _without_activity(
    tables: Mapping[str, DataFrame], options: argparse.Namespace, as_of: datetime | str
) -> DataFrame:
    """The accounts that the activity rule lists, from the event tables or from what earlier runs kept."""
    if options.since:
        spark = SparkSession.getActiveSession()
        return newly_dormant(expiry_index(spark, options.expiry_index), options.since, as_of)
    spark, recent = tables["account"].sparkSession, None
    if options.activity_state:
        activity_state.advance(tables, options.activity_state)
        state = activity_state.stored_state(spark, options.activity_state)
        recent = activity_state.activity_by_name(state, tables)
    if options.quarantine:
        split = f"{options.out}/{SOURCE_NAMES['attrs']}"
        quarantine.write_split(tables["attrs"], split)
        tables = {**tables, "attrs": quarantine.good_rows(spark, split)}
    if options.expiry_index:
        write_expiry_index(account_expiries(tables, recent=recent), options.expiry_index)
        return dormant_at(expiry_index(spark, options.expiry_index), as_of)
    return dormant_accounts(tables, as_of, ordered=False, recent=recent)


if __name__ == "__main__":
    main()
