"""Mood and habit diary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from daybook import config
from daybook.functions.dates import DateLike
from daybook.functions.numeric import interaction
from daybook.operators.fill import coalesce_mean, fill_after_first_seen
from daybook.operators.labels import ordered_rules
from daybook.operators.scores import ScoreSpec, score_metrics, score_specs
from daybook.operators.shape import (
    backdate, counters_from_scores, first_column, pivot_first, pivot_map, snake_names, unpivot_pairs,
)

_DATE_TEXT = "date_(yyyy-mm-dd)"


def symptom_days(symptoms: DataFrame, entries: DataFrame, as_of: DateLike, keys: Sequence[str] = (),
                 names: Sequence[str] | None = None, order: str = "row_order") -> DataFrame:
    """One row per day with a column per symptom; day ordinals end at ``as_of``.

    Without ``names`` every name of the definitions (a small table, which is read for this)
    and every known one has a column.  Definitions with key columns are a person's own.

    ``order`` is the entry column that decides between two entries for one day and symptom.
    """
    own = [k for k in keys if k in symptoms.columns]
    defs = symptoms.select(
        *own, F.col("ID").alias("SYMPTOM"),
        F.lower(F.regexp_replace("NAME", r"\s+", "_")).alias("_name"),
    )
    if names is None:
        defined = {r[0] for r in defs.where("_name IS NOT NULL").select("_name").distinct().collect()}
        names = [*config.DIARY_SYMPTOMS, *sorted(defined.difference(config.DIARY_SYMPTOMS))]
    dated = backdate(entries, "ENTRY", as_of, keys)
    return pivot_first(dated.join(defs, [*own, "SYMPTOM"]), [*keys, "date"], "_name", "VALUE", order, names)


def symptom_maps(symptoms: DataFrame, entries: DataFrame, as_of: DateLike, keys: Sequence[str] = (),
                 order: str = "row_order", out: str = "symptoms") -> DataFrame:
    """``symptom_days`` with one map per day, name -> value, in place of a column per name; no name is read beforehand."""
    own = [k for k in keys if k in symptoms.columns]
    defs = symptoms.select(
        *own, F.col("ID").alias("SYMPTOM"),
        F.lower(F.regexp_replace("NAME", r"\s+", "_")).alias("_name"),
    )
    dated = backdate(entries, "ENTRY", as_of, keys)
    return pivot_map(dated.join(defs, [*own, "SYMPTOM"]), [*keys, "date"], "_name", "VALUE", order, out)


def diary_sparse(main: DataFrame, symptoms: DataFrame, entries: DataFrame, as_of: DateLike, keys: Sequence[str] = (),
                 order: str = "row_order", out: str = "symptoms") -> DataFrame:
    """The diary with a map of symptoms per day: those recorded, and 1 for those recorded before but not on the day.

    The same values as ``diary_wide``, for people with symptoms of their own: a day holds only the names that its
    own person ever used, whatever the number of names of all people.
    """
    days = snake_names(main)
    days = days.withColumn("date", F.to_date(F.col(f"`{_DATE_TEXT}`"))).drop("id", _DATE_TEXT)
    mapped = days.join(symptom_maps(symptoms, entries, as_of, keys, order, "_cells"), [*keys, "date"], "left").withColumn(
        "_cells", F.coalesce("_cells", F.create_map().cast("map<string,double>")))
    parts = [F.col("_cells").getItem(n) for n in ("liberty", "positive_liberty", "negative_liberty")]
    liberty = F.coalesce(parts[0], (parts[1] + parts[2]) / 2)
    rest = F.map_filter("_cells", lambda n, _: ~n.isin("liberty", "positive_liberty", "negative_liberty"))
    whole = F.map_concat(rest, F.when(liberty.isNotNull(), F.create_map(F.lit("liberty"), liberty)).otherwise(
        F.create_map().cast("map<string,double>")))
    mapped = mapped.withColumn("_cells", whole)
    # Seen on days that the diary has.
    first = mapped.select(*keys, "date", F.explode("_cells").alias("_name", "_v")).groupBy(*keys, "_name").agg(F.min("date").alias("_date"))
    known = first.groupBy(F.struct(F.lit(0).alias("_all"), *keys).alias("_key")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_name", "_date")))).alias("_known"))
    filled = mapped.withColumn("_key", F.struct(F.lit(0).alias("_all"), *keys)).join(known, "_key", "left")
    missing = F.map_filter("_known", lambda n, d: (d < F.col("date")) & ~F.map_contains_key("_cells", n))
    resting = F.coalesce(F.transform_values(missing, lambda n, d: F.lit(1.0)), F.create_map().cast("map<string,double>"))
    done = filled.withColumn(out, F.map_concat("_cells", resting)).drop("_key", "_known", "_cells")
    numbers = [f.name for f in done.schema.fields
               if f.name not in keys and f.dataType.typeName() in ("double", "integer", "long", "float")]
    return first_column(fill_after_first_seen(done, numbers, keys).fillna("", subset=["note"]), "date")


def diary_wide(main: DataFrame, symptoms: DataFrame, entries: DataFrame, as_of: DateLike,
               keys: Sequence[str] = (), names: Sequence[str] | None = None,
               order: str = "row_order") -> DataFrame:
    """The diary, a row per day: missing symptoms rest at 1 once they were first recorded."""
    days = snake_names(main)
    days = days.withColumn("date", F.to_date(F.col(f"`{_DATE_TEXT}`"))).drop("id", _DATE_TEXT)
    wide = days.join(symptom_days(symptoms, entries, as_of, keys, names, order), [*keys, "date"], "left")
    wide = coalesce_mean(wide, "liberty", "positive_liberty", "negative_liberty")
    wide = first_column(wide.drop("positive_liberty", "negative_liberty"), "date")
    numbers = [
        f.name for f in wide.schema.fields
        if f.name not in keys and f.dataType.typeName() in ("double", "integer", "long", "float")
    ]
    return fill_after_first_seen(wide, numbers, keys).fillna("", subset=["note"])


def diary_scores(wide: DataFrame, rules: Sequence[tuple[str, float]] = (), keys: Sequence[str] = (),
                 specs: Mapping[str, ScoreSpec] | None = None, regex: bool = True) -> DataFrame:
    """(keys, date, note, metric, value, value_partial): four metrics a day.

    ``rules`` are (pattern, elevated) pairs for days the note marks as special; the last
    matching one wins.  (keys, date) must be unique in ``wide``.
    """
    specs = score_specs() if specs is None else specs
    if rules:
        wide = wide.withColumn("elevated", ordered_rules(F.col("note"), F.col("elevated"), rules, regex))
    both = wide.withColumn(config.INTERACTION_COLUMN, interaction(F.col("anxiety"), F.col("depressed")))
    return unpivot_pairs(score_metrics(both, specs), [*keys, "date", "note"], list(specs))


def diary_counters(wide: DataFrame, keys: Sequence[str] = (),
                   cols: Sequence[str] = config.DIARY_COUNTERS) -> DataFrame:
    """(keys, date, counters): how often, from scores that start at 1."""
    return counters_from_scores(wide, [*keys, "date"], cols)
