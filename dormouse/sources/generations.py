"""Tables that are replaced in part: files of numbered generations, of which a manifest names those that count.

A run writes new files beside the old ones and then, as its very last act, one small row
that says which generations make up the table. Who reads takes the newest row, so a run that
ends half-way changes nothing, and files that did not change stay where they are. Rows are
appended by a committed write of one file each. Runs on one table follow each other: a run that finds
that another one has published meanwhile is refused.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "generation long, body string"


@dataclass(frozen=True)
class Manifest:
    """``places`` maps parts of the table to the generation that holds them; ``marks`` is for the table's owner."""

    generation: int
    places: dict[str, int]
    schema: str = ""
    marks: dict[str, int] = field(default_factory=dict)


def data_folder(root: str) -> str:
    return f"{root}/data"


def published(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest, or None before the first run has ended."""
    rows = _rows(spark, root)
    newest = rows.orderBy(F.desc("generation")).first() if rows is not None else None
    return None if newest is None else Manifest(**json.loads(newest["body"]))


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Makes the generation count. It has to be the one after the newest."""
    before = published(spark, root)
    if manifest.generation != (before.generation + 1 if before else 1):
        raise RuntimeError(f"generation {manifest.generation} of {root} does not follow {before and before.generation}")
    row = spark.createDataFrame([(manifest.generation, json.dumps(asdict(manifest)))], _SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{root}/manifest")


def _rows(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SCHEMA).json(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
