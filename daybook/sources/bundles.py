"""The export bundles: which members they hold and which tables those become."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from daybook import config, schemas
from daybook.session import shared_folder
from daybook.sources.archives import member_path, stage_members, staged_archives
from daybook.sources.csvs import read_csv
from daybook.sources.xmls import read_elements

_DIARY_MEMBERS = {
    "main": ("entry.csv", schemas.DIARY_MAIN),
    "symptoms": ("custom_symptom.csv", schemas.DIARY_SYMPTOM),
    "entries": ("entry_custom_symptom.csv", schemas.DIARY_ENTRY),
}


def _staged(spark: SparkSession, path: str, members: list[str], staging: str | None, name: str, by_archive: bool) -> str:
    folder = f"{staging or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    found = stage_members(spark, path, folder, members)
    missing = [m for m in members if m not in found]
    if missing:
        raise FileNotFoundError(f"{path} has no member {', '.join(missing)}")
    if not by_archive and len(archives := staged_archives(spark, folder)) > 1:
        raise ValueError(f"{path} matches {len(archives)} archives, which by_archive keeps apart")
    return folder


def load_health_export(spark: SparkSession, path: str, staging: str | None = None,
                       require_rows: bool = False, by_archive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, workouts) of a health archive, or of an unpacked ``.xml`` file.

    ``path`` may match many archives, one per person; ``by_archive`` then adds the column
    ``archive`` to tell them apart.
    """
    if path.endswith(".xml"):
        xml, keep = path, []
    else:
        member = config.HEALTH_EXPORT_MEMBER
        xml = member_path(_staged(spark, path, [member], staging, "health_export", by_archive), member)
        keep = ["archive"] if by_archive else []
    records = read_elements(spark, xml, "Record", schemas.HEALTH_RECORD, keep=keep)
    workouts = read_elements(spark, xml, "Workout", schemas.HEALTH_WORKOUT, keep=keep)
    if require_rows:
        for name, df in (("Record", records), ("Workout", workouts)):
            if df.isEmpty():
                raise ValueError(f"{path} has no {name} element")
    return records, workouts


def load_diary_export(spark: SparkSession, path: str, staging: str | None = None,
                      by_archive: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(main diary, symptom definitions, symptom entries) of one or many diary archives.

    A note may hold line breaks, so the main diary is read in multi-line mode.  Entries
    carry their file order, which decides between two entries for one day and symptom.
    """
    members = [m for m, _ in _DIARY_MEMBERS.values()]
    folder = _staged(spark, path, members, staging, "diary_export", by_archive)
    return tuple(
        read_csv(spark, member_path(folder, member), schema, multi_line=name == "main",
                 ordinal="row_order" if name == "entries" else None, keep=["archive"] if by_archive else [])
        for name, (member, schema) in _DIARY_MEMBERS.items()
    )
