"""Text rules, batched requests, answers and label roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from daybook import config
from daybook.functions.text import fill_template
from daybook.operators.shape import explode_labels
from daybook.operators.stats import mode_or_unclear

ANSWER_SCHEMA = "array<struct<exercise_name: string, muscle_groups: string, match_score: int>>"


_SPECIAL = set("\\.^$*+?{}[]|()")


def ordered_rules(text: Column, default: Column, rules: Sequence[tuple[str, float]],
                  regex: bool = True) -> Column:
    """Score of the last rule found in ``text``, else ``default``; NULL text matches nothing.

    Rules are tried from the last one on, and only until one matches.  A pattern without
    special characters is looked for as plain text.
    """
    hits = [
        F.when(text.rlike(p) if regex and _SPECIAL & set(p) else text.contains(p), F.lit(score))
        for p, score in rules
    ]
    return F.coalesce(*reversed(hits), default)


_GRAM = 3


def _grams(text: Column) -> Column:
    """The distinct runs of three characters of a text, in one pass over it."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?s)(?=(.{3}))"), F.lit(1)))


def literal_grams(pattern: Column, regex: bool = True) -> Column:
    """Runs of three characters that every text a pattern is found in must hold; none is found for alternatives, options
    and groups, which need not be there, nor for classes and single letters."""
    if not regex:
        return _grams(pattern)
    gap = "\n"
    rest = pattern
    for old in (r"\\Q.*", r"\\.", r"\[\^?\]?[^\]]*\]"):
        rest = F.regexp_replace(rest, old, gap)
    for _ in range(4):
        rest = F.regexp_replace(rest, r"\([^()]*\)[*+?{]?", gap)
    for old in (r"[^\n][*?]", r"[^\n]\{[^}]*\}", r"[.^$+\n]+"):
        rest = F.regexp_replace(rest, old, gap)
    runs = F.filter(F.split(rest, gap), lambda run: F.char_length(run) >= _GRAM)
    found = F.array_distinct(F.flatten(F.transform(runs, _grams)))
    return F.when(pattern.rlike(r"[|]|\(\?") | rest.rlike(r"[()\[\]]"), F.array().cast("array<string>")).otherwise(found)


def rule_scores(df: DataFrame, text: str, rules: DataFrame, out: str, default: Column | None = None, regex: bool = True,
                ordinal: str = "ordinal", pattern: str = "pattern", score: str = "score") -> DataFrame:
    """Rows with the score of the rule of the largest ``ordinal`` found in ``text``, else ``default``.

    ``rules`` is a table of any size.  Each rule is looked up by the rarest run of three characters that its pattern
    cannot do without; only texts that hold this run are held against the pattern, each distinct text once.  A text
    gathers the rules that it is held against, so it travels once and not once per rule.  Rules without such a run
    (alternatives, single letters) are few and are tried on every distinct text.  A NULL text, pattern or ordinal
    matches nothing; of equal ordinals the largest score counts.
    """
    texts = df.select(F.col(text).alias("_text")).where(F.col(text).isNotNull()).distinct().withColumn("_h", F.xxhash64("_text"))
    told = rules.select(F.col(ordinal).alias("_nth"), F.col(pattern).alias("_pattern"), F.col(score).alias("_score")).where(
        F.col("_nth").isNotNull() & F.col("_pattern").isNotNull()).distinct()
    told = told.withColumn("_needs", literal_grams(F.col("_pattern"), regex))
    rule = F.struct("_nth", "_score", "_pattern")
    wanted = told.select(rule.alias("_rule"), F.explode("_needs").alias("_gram"))
    # Texts travel as a hash, which may bring a rule too many to a text but never one too few.
    grams = texts.select("_h", F.explode(_grams(F.col("_text"))).alias("_gram")).join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    often = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    # A run that no text holds is the rarest; the rule then meets nothing.
    anchors = wanted.join(often, "_gram", "left").groupBy("_rule").agg(
        F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    met = grams.join(anchors, "_gram").groupBy("_h").agg(F.collect_list("_rule").alias("_rules"))
    loose = told.where(F.size("_needs") == 0).agg(F.collect_list(rule)).scalar()
    tried = texts.join(met, "_h", "left").select("_text", F.concat(F.coalesce("_rules", F.array()), loose).alias("_rules"))
    found = F.filter("_rules", lambda r: F.call_function("rlike" if regex else "contains", F.col("_text"), r["_pattern"]))
    best = tried.select("_text", F.array_max(found).alias("_best")).where("_best IS NOT NULL")
    value = F.coalesce(F.col("_best._score"), F.lit(None) if default is None else default)
    return df.join(best, F.col(text) == F.col("_text"), "left").withColumn(out, value).drop("_best", "_text")


# Hex digits of the hash that make up a block; a block holds 1/16**digits of the names.
_BLOCK_DIGITS = 3


def batch_names(df: DataFrame, name: str, size: int = config.NAMES_PER_REQUEST,
                template: str | None = None, values: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct names in batches of ``size``: (batch, n_names, names[, request]).

    Names are numbered in the order of their MD5, in two levels: inside blocks of equal hash
    prefix, which are evenly sized whatever the names look like, and across the few blocks.
    """
    names = df.select(name).where(F.col(name).isNotNull()).distinct()
    hashed = names.withColumn("_hash", F.md5(F.col(name))).withColumn(
        "_block", F.substring("_hash", 1, _BLOCK_DIGITS)
    )
    sizes = hashed.groupBy("_block").agg(F.count("*").alias("_size"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    in_block = F.row_number().over(W.partitionBy("_block").orderBy("_hash", name))
    numbered = hashed.withColumn("_i", in_block).join(offsets, "_block").select(
        name, (F.col("_offset") + F.col("_i") - 1).alias("_n")
    )
    batches = (
        numbered.groupBy(F.expr(f"_n div {size}").alias("batch"))
        .agg(F.sort_array(F.collect_list(F.struct("_n", name))).alias("_names"))
        .select("batch", F.size("_names").alias("n_names"),
                F.array_join(F.col(f"_names.{name}"), ", ").alias("names"))
    )
    if template is None:
        return batches
    filled = fill_template(template, {"names": F.col("names"), **(values or {})})
    return batches.withColumn("request", filled)


_BLANKS = " \t\n\r\x0b\x0c"


def answer_json(text: Column) -> Column:
    """The JSON inside a fenced answer, or the whole text; NULL unless it is a closed list."""
    blanks = F.lit(_BLANKS)
    fenced = F.rtrim(F.btrim(F.split_part(text, F.lit("```json"), F.lit(2)), blanks), F.lit("`"))
    body = F.btrim(F.when(text.contains("```json"), fenced).otherwise(text), blanks)
    # from_json ignores what follows the closing bracket, so that is ruled out here.
    return F.when(body.startswith("[") & body.endswith("]"), body)


def parse_answers(df: DataFrame, col: str, schema: str = ANSWER_SCHEMA,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One row per object of each answer; unreadable answers give none."""
    parsed = df.select(*keep, F.from_json(answer_json(F.col(col)), schema).alias("_rows"))
    return parsed.select(*keep, F.inline("_rows"))


def muscle_group_table(spark, groups: Mapping[str, tuple[str, str]] = config.MUSCLE_GROUPS) -> DataFrame:
    from daybook.sources.literal import literal_table

    return literal_table(
        spark, ["Muscle_Group", "Anterior_Posterior", "Push_Pull_Legs"],
        [(name, *classes) for name, classes in groups.items()],
    )


def rollup_labels(answers: DataFrame, groups: DataFrame, series: str = "exercise_name",
                  labels: str = "muscle_groups", group: str = "Muscle_Group",
                  classes: Sequence[str] = ("Anterior_Posterior", "Push_Pull_Legs"),
                  keys: Sequence[str] = ()) -> DataFrame:
    """One row per answer and label, with one class per series: the unique mode of its labels'."""
    exploded = explode_labels(answers, labels, "_label")
    merged = exploded.join(groups, exploded["_label"] == groups[group], "left")
    rolled = mode_or_unclear(merged, [*keys, series], classes, config.UNCLEAR)
    return merged.drop("_label", *classes).join(rolled, [*keys, series], "left")
