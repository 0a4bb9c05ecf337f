"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def strip_token(col: Column, token: str) -> Column:
    """Remove every literal occurrence of ``token``."""
    return F.replace(col, F.lit(token), F.lit(""))


def capture(col: Column, pattern: str, group: int = 1) -> Column:
    """First regex capture; NULL when nothing matches."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


# A private-use marker: initcap() only starts words after a blank, so a marker plus a
# blank goes in wherever a word starts after punctuation and comes out afterwards.
_MARK = "\u0001 "


def title_case(col: Column) -> Column:
    """Title case with words also starting after punctuation, e.g. ``Press (Barbell)``."""
    marked = F.regexp_replace(col, r"([^\p{L}\p{N}' ])(?=\p{L})", "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def pretty_name(col: Column) -> Column:
    """``mental_health`` -> ``Mental Health``."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def whole_number_text(col: Column) -> Column:
    """Half-even rounded number as text."""
    return F.bround(col).cast("bigint").cast("string")


def lift_label(date: Column, name: Column, estimate: Column) -> Column:
    return F.concat_ws(
        " ",
        F.lit("Date:"), date.cast("string"),
        F.lit("<br>Exercise:"), name,
        F.lit("<br>Estimated 1RM:"), whole_number_text(estimate),
    )


def metric_label(date: Column, value: Column, note: Column) -> Column:
    """The note part is empty, not absent, without a note: the label ends in a blank then."""
    note_part = F.when(note.isNull() | (note == ""), F.lit("")).otherwise(
        F.concat(F.lit("<br>Note: "), note)
    )
    return F.concat_ws(
        " ",
        F.lit("Date:"), date.cast("string"),
        F.lit("<br>Value:"), whole_number_text(value),
        note_part,
    )


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """``{name}`` placeholders of ``template`` filled from columns, as one expression."""
    pieces: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not hits:
            pieces.append(F.lit(rest))
            break
        at, name = min(hits)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2:]
    return F.concat(*pieces)
