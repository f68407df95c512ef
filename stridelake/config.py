"""Business constants. Everything a caller may want to change is a field of ``Thresholds``."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: texts, names and limits that results must carry exactly as they are ---

TIME_PATTERN = "M/d/yyyy h:mm:ss a"
DATE_PATTERN = "M/d/yyyy"

MASK_PREFIX = "USR_"

BADGES = (
    (100, "First Step 🥉"),
    (500, "5 Day Warrior 🥈"),
    (1000, "10K Champion 🥇"),
    (5000, "Fitness Legend 🏆"),
)

LEVEL_BY_CODE = ((0, "HIGH"), (1, "MEDIUM"), (2, "LOW"), (3, "SEDENTARY"))

FEATURES = (
    "total_steps",
    "total_calories",
    "active_minutes",
    "sleep_minutes",
    "avg_intensity",
    "max_steps_in_minute",
)

WORKOUT = "WORKOUT_COMPLETED"
INACTIVITY = "INACTIVITY_DETECTED"
FRAUD = "FRAUD_DETECTED"

FRAUD_SUBJECT = "🚨 Fraud Detected!"
REWARD_SUBJECT = "Workout Reward Earned! 💪"
REMINDER_SUBJECT = "Daily Activity Reminder 🏃"
PREDICTION_SUBJECT = "Daily Predictions Complete ✅"
CLEANUP_SUBJECT = "S3 Cleanup Complete ✅"

STORAGE_RATE_PER_GB_MONTH = 0.023

# (store, prefix, days to keep)
RETENTION_RULES = (
    ("bronze", "minute_data/", 90),
    ("gold", "predictions/", 30),
    ("gold", "cost-reports/", 365),
    ("silver", "minute_data/", 365),
)

# layer -> days to keep, by the age of the data itself
LAYER_RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 7 * 365, "models": 2 * 365}

PIPELINE_VERSION = "v1.0"

# --- end of fixed values ---


@dataclass(frozen=True)
class Thresholds:
    """Limits used by the rules, scores and flags."""

    # minute level
    active_minute_steps: int = 10
    max_steps_per_minute: int = 200
    max_calories_per_minute: int = 20

    # daily goals
    steps_goal: int = 8000
    very_active_goal: int = 30
    sedentary_limit: int = 600

    # anomaly score: (steps above, score), tried in order
    anomaly_tiers: tuple = ((15000, 0.8), (12000, 0.5))
    anomaly_idle: float = 0.3
    anomaly_normal: float = 0.1

    # activity level: (steps at least, level), tried in order
    level_tiers: tuple = ((10000, "HIGH"), (5000, "MEDIUM"), (1000, "LOW"))
    level_floor: str = "SEDENTARY"

    # decisions
    fraud_score: float = 0.8
    fraud_steps: int = 15000
    workout_steps: int = 10000
    workout_points: int = 100
    risk_scores: tuple = (("HIGH", 10), ("MEDIUM", 30), ("LOW", 60))
    risk_score_floor: int = 90
    discount_at_most: int = 10
    surcharge_at_least: int = 90

    # reward eligibility
    eligible_active_days: int = 5
    eligible_active_streak: int = 3
    eligible_sedentary_below: int = 4

    # model
    positive_weight: float = 5.0
    boosting_rounds: int = 100
    tree_depth: int = 5
    learning_rate: float = 0.2


DEFAULTS = Thresholds()
