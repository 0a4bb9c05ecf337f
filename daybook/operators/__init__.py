"""Table operators: ``DataFrame -> DataFrame``, usable through ``df.transform``.

Shared rules:

* A window is partitioned by a series only over a table already reduced to one row per
  series and day, so a partition is bounded by the calendar, however many rows a series has.
* Row-level results come from joining that daily table back on (series, day).  These joins
  carry no hint: Spark broadcasts the daily side when its measured size allows, and
  otherwise joins by shuffle, where adaptive execution splits hot (series, day) keys.
"""
