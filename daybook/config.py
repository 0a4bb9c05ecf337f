"""Names, tables, goals and breaks the results depend on."""

from __future__ import annotations

import math

# --- measurements -----------------------------------------------------------------
# Prefixes and patterns of the health export.
RECORD_TYPE_PREFIX = "HKQuantityTypeIdentifier"
WORKOUT_TYPE_PREFIX = "HKWorkoutActivityType"
DEVICE_NAME_PATTERN = r"name:(.*?),"
BODY_MASS_TYPE = "BodyMass"
HEALTH_EXPORT_MEMBER = "apple_health_export/export.xml"
RECORD_COLUMNS_DROPPED = ("sourceversion", "creationdate", "startdate")

# Pounds per kilogram, bar weight, marker of barbell exercises.
POUNDS_PER_KG = 2.20462
BARBELL_TAG = "(Barbell)"
BARBELL_WEIGHT = 44.0

# Workout types kept, in two groups.
SOCCER_TYPES = ("Soccer",)
OTHER_WORKOUT_TYPES = (
    "Running", "Swimming", "Cycling", "Hiking", "StairClimbing", "CardioDance",
    "Rowing", "Other", "Cooldown", "Yoga",
)
WORKOUT_TYPES = SOCCER_TYPES + OTHER_WORKOUT_TYPES

# Workout types whose energy counts beside lifting volume.
ENERGY_WORKOUT_TYPES = ("Soccer", "Running", "Hiking", "StairClimbing")

# Column of an enriched workout -> (measurement, how it is combined).
WORKOUT_MEASURES = {
    "hr_mean": ("HeartRate", "avg"),
    "total_energy_burned": ("ActiveEnergyBurned", "sum"),
    "total_distance": ("DistanceWalkingRunning", "sum"),
}

# Exercises that lift the body's own weight.
UNWEIGHTED_EXERCISES = (
    "Chin Up",
    "Pull Up",
    "Wide Pull Up",
    "Back Extension",
    "Ab Coaster",
    "Battle Ropes",
    "Press Up",
    "Chest Dip",
    "Triceps Dip",
    "Curved Hack Squat",
    "Bulgarian Split Squat (Plate-Loaded)",
    "Knee Raise (Captain's Chair)",
    "Half-Hack Squat",
    "Goblet Squat (Kettlebell)",
    "Lunge (Dumbbell)",
)

# Metric names of the filled daily tables.
METRIC_SETS = {
    "energy": (
        "Calorie expenditure",
        "Calorie intake",
        "Calorie deficit (absolute)",
        "Calorie deficit (relative)",
    ),
    "nutrition": ("Protein", "Sugar", "Water", "Carbohydrates", "Fat"),
    "volume": ("hypertrophy_adjusted_volume", "volume"),
}

# --- labels -----------------------------------------------------------------------
# Muscle group -> (anterior or posterior, push, pull or legs).
MUSCLE_GROUPS = {
    "chest": ("anterior", "push"),
    "front delt": ("anterior", "push"),
    "side delt": ("anterior", "push"),
    "triceps": ("anterior", "push"),
    "abs": ("anterior", "push"),
    "obliques": ("anterior", "push"),
    "trapezius": ("posterior", "pull"),
    "lats": ("posterior", "pull"),
    "rear delt": ("posterior", "pull"),
    "biceps": ("posterior", "pull"),
    "forearms": ("posterior", "pull"),
    "lower back": ("posterior", "pull"),
    "rhomboids": ("posterior", "pull"),
    "neck": ("posterior", "pull"),
    "quads": ("anterior", "legs"),
    "calves": ("anterior", "legs"),
    "adductors": ("anterior", "legs"),
    "hamstrings": ("posterior", "legs"),
    "glutes": ("posterior", "legs"),
    "abductors": ("posterior", "legs"),
}
# How an undecided class is written, and names per request.
UNCLEAR = "Unclear"
UNCLEAR_LABELS = ("Unclear", "unclear")
NAMES_PER_REQUEST = 10

# --- diary ------------------------------------------------------------------------
# Diary columns that rest at 0; every other one rests at 1.
ZERO_BASELINE = ("elevated", "depressed", "anxiety")
INTERACTION_COLUMN = "anxiety_depression_interaction"
INTERACTION_POWER = 6.6582

# Score -> (rescale, {column: (min, max, weight, power)}).
SCORES = {
    "mental_health": (False, {
        "elevated": (1, 4, 1, 2.8675),
        "anxiety_depression_interaction": (1, 4, -1, 1),
    }),
    "subjective_well_being": (True, {
        "elevated": (1, 4, 1, 2),
        "energy": (1, 4, 1, 2),
        "fun": (1, 4, 0.5, 2),
        "dog_interaction": (1, 2, 4, 1),
        "anxiety": (1, 4, -1, 2),
        "conflict": (1, 2, -4, 1),
        "depressed": (1, 4, -1, 2),
    }),
    "life_satisfaction": (True, {
        "self-acceptance": (1, 4, 1, 1),
        "liberty": (1, 4, 2, 1),
        "value_alignment": (1, 4, 2, 1),
        "health": (1, 4, 2, 1),
        "security": (1, 4, 2, 1),
        "relationship_satisfaction": (1, 4, 2, 1),
        "integrity": (1, 4, 2, 1),
        "optimism": (1, 4, 1, 1),
        "shame": (1, 4, -1, 2),
        "suicidality": (1, 2, -4, 1),
    }),
    "work_satisfaction": (True, {
        "energy": (1, 4, 1, 1),
        "mental_clarity": (1, 4, 2, 2),
        "value_alignment": (1, 4, 1, 2),
        "security": (1, 4, 1, 1),
        "relationship_satisfaction": (1, 4, 1, 1),
        "liberty": (1, 4, 2, 1),
        "achievement": (1, 4, 4, 1),
        "learning": (1, 4, 0.5, 1),
        "work_depth": (1, 4, 0.5, 2),
        "professional_mastery": (1, 4, 2, 1),
    }),
}
# Shares of known terms that a full and a partial score need.
FULL_CUTOFF = 1.0
PARTIAL_CUTOFF = 0.5

# Symptom names (after snake-casing) that always have a column.
DIARY_SYMPTOMS = (
    "energy", "fun", "dog_interaction", "conflict", "self-acceptance", "liberty",
    "positive_liberty", "negative_liberty", "value_alignment", "health", "security",
    "relationship_satisfaction", "integrity", "optimism", "shame", "suicidality",
    "mental_clarity", "achievement", "learning", "work_depth", "professional_mastery",
    "asked_how_friends_are", "energizing_personal_interactions",
    "energizing_professional_interactions", "floss",
)
DIARY_COUNTERS = (
    "asked_how_friends_are",
    "energizing_personal_interactions",
    "energizing_professional_interactions",
    "floss",
)

# --- views ------------------------------------------------------------------------
# What a view shows when nothing is chosen.
DEFAULT_EXERCISES = ("Chin Up", "Bench Press (Barbell)")
DEFAULT_METRICS = ("mental_health",)
METRIC_AXIS = (-101.0, 101.0)
DEFAULT_VOLUME_EPSILON = 0.005
DEFAULT_METRIC_EPSILON = 0.0035

# Point emphasis for best lifts, other lifts, and no highlighting.
EMPHASIS_BEST, EMPHASIS_OTHER, EMPHASIS_PLAIN = 0.5, 0.05, 0.2

# Fixed values: (metric, kind of category, months per bin) -> upper breaks; the first
# bucket starts at 0, the last one is open.
_OPEN = math.inf
BUCKET_BREAKS = {
    ("Frequency", "class", 2): (0, 30, 100, 300, _OPEN),
    ("Frequency", "series", 2): (0, 3, 10, 30, 100, _OPEN),
    ("Frequency", "class", 4): (0, 100, 300, 1000, _OPEN),
    ("Frequency", "series", 4): (0, 3, 10, 30, 100, _OPEN),
    ("Volume", "class", 2): (0, 3000, 10000, 30000, 100000, _OPEN),
    ("Volume", "series", 2): (0, 300, 1000, 3000, 10000, _OPEN),
    ("Volume", "class", 4): (0, 10000, 30000, 100000, _OPEN),
    ("Volume", "series", 4): (0, 1000, 3000, 10000, 30000, _OPEN),
}
# The class columns, and the exercises a heat map shows.
CLASS_CATEGORIES = ("Push_Pull_Legs", "Anterior_Posterior")
TOP_SERIES = 10

# Series picker.
PICKER_MIN_ROWS = 50
PICKER_MAX_AGE = 1000
PICKER_PRIOR_DAYS = 60

# --- goals ------------------------------------------------------------------------
# The goals' year and where its baseline begins.
GOAL_YEAR = 2024
BASELINE_FROM = "2023-10-01"

# Estimated one-rep-max to reach.
MAX_GOALS = {
    "Bench Press (Barbell)": 260.0,
    "Overhead Press (Barbell)": 140.0,
    "Squat (Barbell)": 260.0,
    "Romanian Deadlift (Barbell)": 320.0,
    "Bent Over Row (Barbell)": 200.0,
    "Chin Up": 260.0,
}
# Category -> (times, least minutes).
COUNT_GOALS = {
    "Soccer": (30, 30.0),
    "Cardio": (24, 10.0),
    "Stretching": (48, 5.0),
}
# Workout type -> category.
TYPE_CATEGORIES = {
    "Soccer": "Soccer",
    "Running": "Cardio",
    "Swimming": "Cardio",
    "Cycling": "Cardio",
    "Hiking": "Cardio",
    "StairClimbing": "Cardio",
    "CardioDance": "Cardio",
    "Rowing": "Cardio",
    "Yoga": "Stretching",
    "Cooldown": "Stretching",
}
# Counter column -> (goal name, goal).
SUM_GOALS = {
    "energizing_professional_interactions": ("ProfessionalMeetings", 50),
    "asked_how_friends_are": ("AskFriendsUpdates", 50),
    "energizing_personal_interactions": ("FriendMeetings", 100),
}
# Weekly goal: column, name, weeks, days that make a week count.
WEEKLY_GOAL = ("floss", "FlossingWeeks", 26, 3)
