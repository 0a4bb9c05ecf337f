"""Synthetic exports, written with a fixed seed."""

from __future__ import annotations

import csv
import datetime as dt
import io
import random
import zipfile
from xml.sax.saxutils import quoteattr

AS_OF = dt.date(2024, 3, 10)
START = dt.date(2023, 9, 1)


def _element(tag: str, attrs: dict, body: str = "") -> str:
    text = " ".join(f"{k}={quoteattr(str(v))}" for k, v in attrs.items())
    return f"<{tag} {text}>{body}</{tag}>" if body else f"<{tag} {text}/>"


def _record(kind: str, end: str, value, device: str | None = None, start: str | None = None) -> dict:
    attrs = {"type": f"HKQuantityTypeIdentifier{kind}", "sourceVersion": "10.1"}
    if device:
        attrs["device"] = device
    return {**attrs, "creationDate": end, "startDate": start or end, "endDate": end, "value": value}


WEIGHTS = [  # (local time, kilograms): a bad first value, two on one day, gaps, late evening
    ("2023-09-01 07:00:00 -0800", "n/a"), ("2023-09-03 23:42:40 -0800", "80.0"), ("2023-09-03 07:00:00 -0800", "81.0"),
    ("2023-09-08 07:00:00 -0800", "84.0"), ("2024-03-01 07:00:00 -0800", "78.0"),
]
HEART = [  # (start, end, value) around the workout of 2024-01-05 10:00-11:00
    ("10:00:00", "10:00:10", 100), ("10:59:00", "11:00:00", 140), ("09:59:59", "10:00:10", 500), ("10:59:59", "11:00:01", 500),
    ("09:00:00", "12:00:00", 900),
]
WORKOUTS = [  # (type, start, minutes, distance)
    ("Soccer", "2024-01-05 10:00:00 -0800", 60, 0), ("Soccer", "2024-01-31 23:30:00 -0800", 45, 5),
    ("Soccer", "2024-02-02 10:00:00 -0800", 20, 1), ("Running", "2024-02-03 10:00:00 -0800", 30, 4),
    ("Yoga", "2023-12-31 23:00:00 -0800", 30, 0), ("Tennis", "2024-02-05 10:00:00 -0800", 60, 0),
    ("Cooldown", "2024-02-06 10:00:00 -0800", "bad", 0),
]


def health_xml() -> str:
    watch = "<<HKDevice: 0x1>, name:Watch A, manufacturer:M>"
    rows = [_element("Record", _record("BodyMass", t, v, watch), _element("MetadataEntry", {"key": "k", "value": ">v"}))
            for t, v in WEIGHTS[:-1]]
    nested = _element("Record", _record("BodyMass", *WEIGHTS[-1], "<<HKDevice: 0x2>, model:X>"))
    rows.append(f"<Correlation type=\"C\">{nested}</Correlation>")
    day = "2024-01-05 "
    rows += [_element("Record", _record("HeartRate", f"{day}{e} -0800", v, watch, f"{day}{s} -0800")) for s, e, v in HEART]
    rows.append(_element("RecordLike", {"type": "x"}))
    for kind, start, minutes, distance in WORKOUTS:
        begin = dt.datetime.strptime(start, "%Y-%m-%d %H:%M:%S %z")
        end = begin + dt.timedelta(minutes=minutes if isinstance(minutes, int) else 10)
        rows.append(_element("Workout", {
            "workoutActivityType": f"HKWorkoutActivityType{kind}", "duration": minutes, "totalDistance": distance,
            "totalEnergyBurned": 100, "startDate": start, "endDate": end.strftime("%Y-%m-%d %H:%M:%S %z"),
        }, _element("WorkoutEvent", {"type": "pause"})))
    body = "\n ".join(rows)
    return f"""<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE HealthData [
<!ELEMENT Record ((MetadataEntry|HeartRate)*)>
]>
<HealthData locale="en">
 {body}
</HealthData>
"""


EXERCISES = ("Bench Press (Barbell)", "Chin Up", "Lateral Raise (Dumbbell)", "")


def strength_rows() -> list[dict]:
    rng = random.Random(11)
    rows = []
    for offset in (0, 2, 7, 31, 32, 61, 121, 122, 140, 160, 190):
        day = START + dt.timedelta(days=offset)
        for name in EXERCISES:
            for number in (1, 2, 3):
                rows.append({
                    "Date": f"{day} 18:30:00", "Workout Name": "W, \"x\"", "Exercise Name": name, "Set Order": number,
                    "Weight": rng.choice([0, 40, 45.5, 50]), "Reps": rng.choice([0, 1, 5, 12]), "Notes": "",
                })
    return rows


def _csv(names: list[str], rows: list[dict]) -> str:
    out = io.StringIO()
    writer = csv.DictWriter(out, names, lineterminator="\n")
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


SYMPTOMS = (
    "Energy", "Fun", "Dog interaction", "Conflict", "Self-Acceptance", "Liberty", "Positive  Liberty", "Negative Liberty",
    "Value alignment", "Health", "Security", "Relationship satisfaction", "Integrity", "Optimism", "Shame", "Suicidality",
    "Mental clarity", "Achievement", "Learning", "Work depth", "Professional mastery", "Asked how friends are",
    "Energizing personal interactions", "Energizing professional interactions", "Floss",
)
FIRST_FLOSS = 40
DIARY_DAYS = 60


def diary() -> dict[str, str]:
    rng = random.Random(5)
    main, entries = [], []
    for i in range(DIARY_DAYS):
        day = AS_OF - dt.timedelta(days=DIARY_DAYS - 1 - i)
        note = {3: "a fine trip, then\na great trip", 4: "", 5: "great, great"}.get(i, "plain")
        main.append({"ID": i, "DATE (YYYY-MM-DD)": day, "NOTE": note, "elevated": rng.randrange(0, 4),
                     "depressed": rng.randrange(0, 4), "anxiety": rng.randrange(0, 4), "irritability": 1})
        for number, name in enumerate(SYMPTOMS, 1):
            if name == "Floss" and i < FIRST_FLOSS or rng.random() < 0.3:
                continue
            entries.append({"SYMPTOM": number, "ENTRY": 500 + i, "VALUE": rng.randrange(1, 5)})
    # The last day has an entry for sure; a second value for one day and symptom loses.
    entries.append({"SYMPTOM": 1, "ENTRY": 500 + DIARY_DAYS - 1, "VALUE": 2})
    first = next(e for e in entries if e["SYMPTOM"] == 2)
    entries.append({**first, "VALUE": first["VALUE"] + 10})
    definitions = [{"ID": n, "NAME": name} for n, name in enumerate(SYMPTOMS, 1)]
    return {
        "entry.csv": _csv(list(main[0]), main),
        "custom_symptom.csv": _csv(["ID", "NAME"], definitions),
        "entry_custom_symptom.csv": _csv(["SYMPTOM", "ENTRY", "VALUE"], entries),
    }


def write_zip(path, members: dict[str, str]) -> str:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return str(path)


def write_all(folder) -> dict[str, str]:
    log = folder / "strength.csv"
    rows = strength_rows()
    log.write_text(_csv(list(rows[0]), rows))
    return {
        "health": write_zip(folder / "export.zip", {
            "apple_health_export/export.xml": health_xml(), "apple_health_export/other.txt": "no"}),
        "strength_log": str(log),
        "diary": write_zip(folder / "diary.zip", diary()),
    }
