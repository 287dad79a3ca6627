"""Latest activity per key as a stored state, to which a run adds only what came after the last one.

Rows are a kind of activity, the key its events carry, and the latest of them. Keys are those of
the events, not of accounts, so a state stays right when accounts or the key map change. As
states are put together by taking the latest, events may be added twice without harm.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dormouse.defaults import AUDIT_ACCOUNT_TYPE, REACTIVATION_SUFFIX, WATCH_ASSOCIATION
from dormouse.functions.time import millis_to_date
from dormouse.operators import activity
from dormouse.sources.generations import Manifest, data_folder, publish, published

ASSIGNMENT, WATCH, REACTIVATION = "assignment", "watch", "reactivation"
_SCHEMA = "key string, latest long, generation long, kind string"
# A state of more generations than this is put together into one when the next is added.
MAX_GENERATIONS = 8


@dataclass(frozen=True)
class Marks:
    """Up to where the events are in a state: the last change group, and instants of the other two.

    Instants are microseconds of the watch and milliseconds of the audit row, as their tables have them.
    """

    changegroup: int | None = None
    watch: int | None = None
    audit: int | None = None


def marks_of(tables: Mapping[str, DataFrame]) -> Marks:
    """Where the event tables end now."""
    ends = {
        "changegroup": tables["changegroup"].agg(F.max("id")),
        "watch": tables["userassociation"].agg(F.unix_micros(F.max("created"))),
        "audit": tables["audit"].agg(F.max("entity_timestamp")),
    }
    return Marks(**{name: end.first()[0] for name, end in ends.items()})


def _beyond(column: Column, since: int | None, until: int | None, inclusive: bool) -> Column:
    """In the stretch from one mark to another; a null is in every one."""
    wanted = F.lit(True)
    if since is not None:
        wanted = wanted & ((column >= since) if inclusive else (column > since))
    if until is not None:
        wanted = wanted & (column <= until)
    return column.isNull() | wanted if inclusive else wanted


def _instant(micros: int | None) -> Column | None:
    return None if micros is None else F.timestamp_micros(F.lit(micros).cast("long"))


def latest_between(
    tables: Mapping[str, DataFrame], since: Marks = Marks(), until: Marks = Marks()
) -> DataFrame:
    """The latest event per kind and key of the events beyond ``since``, up to ``until``.

    Change groups are numbered, and those up to a mark are not read again. Watches and audit rows have
    nothing but their instants, of which the mark itself may come again; so it is read once more.
    """
    groups = tables["changegroup"].filter(_beyond(F.col("id"), since.changegroup, until.changegroup, False))
    items = tables["changeitem"].filter(_beyond(F.col("groupid"), since.changegroup, until.changegroup, False))
    assigned = activity.last_assignment(groups, items).select(
        F.lit(ASSIGNMENT).alias("kind"), F.col("user_name").alias("key"), F.unix_micros("lastassign").alias("latest")
    )
    created = F.col("created")
    watched = tables["userassociation"].filter(
        (F.col("association_type") == WATCH_ASSOCIATION)
        & _beyond(created, _instant(since.watch), _instant(until.watch), True)
    )
    audited = tables["audit"].filter(
        (F.col("primary_resource_type") == AUDIT_ACCOUNT_TYPE)
        & F.col("change_values").endswith(REACTIVATION_SUFFIX)
        & _beyond(F.col("entity_timestamp"), since.audit, until.audit, True)
    )
    by_key = {
        WATCH: (watched, "source_name", F.unix_micros(F.max("created"))),
        REACTIVATION: (audited, "primary_resource_id", F.max("entity_timestamp")),
    }
    parts = [assigned]
    for kind, (events, key, latest) in by_key.items():
        reduced = events.groupBy(F.col(key).alias("key")).agg(latest.alias("latest"))
        parts.append(reduced.select(F.lit(kind).alias("kind"), "key", "latest"))
    return reduce(DataFrame.unionByName, parts)


def merged(*states: DataFrame) -> DataFrame:
    """The state of the events of all; those of overlapping stretches count once."""
    together = reduce(DataFrame.unionByName, states)
    return together.groupBy("kind", "key").agg(F.max("latest").alias("latest"))


def activity_by_name(state: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Last assignment, reactivation and watch, and the number of issues, per user name, from a state.

    Equal to ``activity.activity_by_name`` of the events that the state was made from. Issues are no
    events: who has them is counted anew.
    """
    of_kind = {kind: state.filter(F.col("kind") == kind) for kind in (ASSIGNMENT, WATCH, REACTIVATION)}
    assigned = of_kind[ASSIGNMENT].select(
        F.col("key").alias("user_name"), F.timestamp_micros("latest").alias("lastassign")
    )
    watched = activity.latest_of_accounts(
        activity.latest_by_key(of_kind[WATCH], "key", F.max("latest"), tables["app_user"]), tables["account"]
    ).select("user_name", F.timestamp_micros("latest").alias("lastwatch"))
    switched_on = activity.latest_by_key(
        of_kind[REACTIVATION], "key", F.max("latest"), tables["app_user"]
    ).select(F.col("lower_user_name").alias("user_name"), millis_to_date(F.col("latest")).alias("lastreactivate"))
    return activity.together_by_name([assigned, switched_on, watched, activity.issue_rows(tables["issue"])])


def advance(tables: Mapping[str, DataFrame], root: str) -> Marks:
    """Adds the events since the last run to the state below ``root``, and gives the new marks.

    What a run writes is the latest of the new events only; it counts once its manifest is
    written, last of all. A run that ended before is made up for by the next one. Now and then all
    generations are put together into one, so that readers have few to merge.
    """
    spark = tables["changegroup"].sparkSession
    before = published(spark, root)
    since = Marks(**before.marks) if before else Marks()
    until = marks_of(tables)
    number = before.generation + 1 if before else 1
    places = {str(number): number}
    found = latest_between(tables, since, until)
    if before and len(before.places) >= MAX_GENERATIONS:
        found = merged(_read(spark, root, before), found)
    elif before:
        places = {**before.places, **places}
    _write(found, root, number)
    # A table without events leaves its mark where it was.
    marks = {name: mark for name, mark in {**vars(since), **_known(until)}.items() if mark is not None}
    publish(spark, root, Manifest(number, places, marks=marks))
    return Marks(**marks)


def _known(marks: Marks) -> dict[str, int]:
    return {name: mark for name, mark in vars(marks).items() if mark is not None}


def stored_state(spark: SparkSession, root: str) -> DataFrame:
    """The state as of its last run that ended, one row for each kind and key."""
    manifest = published(spark, root)
    if manifest is None:
        raise ValueError(f"{root} holds no state")
    return merged(_read(spark, root, manifest))


def _read(spark: SparkSession, root: str, manifest: Manifest) -> DataFrame:
    rows = spark.read.schema(_SCHEMA).parquet(data_folder(root))
    return rows.filter(F.col("generation").isin(*manifest.places.values())).select("kind", "key", "latest")


def _write(rows: DataFrame, root: str, generation: int) -> None:
    rows.select("key", "latest", F.lit(generation).cast("long").alias("generation"), "kind").write.partitionBy(
        "generation", "kind"
    ).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(data_folder(root))
