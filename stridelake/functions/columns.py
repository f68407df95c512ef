"""Column expressions shared by the batch and streaming operators. All are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.config import BADGES, DATE_PATTERN, DEFAULTS, LEVEL_BY_CODE, MASK_PREFIX, TIME_PATTERN, Thresholds


def parse_ts(c: Column) -> Column:
    """Device time text to a zone-less timestamp; unreadable text gives NULL."""
    return F.try_to_timestamp(c, F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def parse_date(c: Column) -> Column:
    return F.try_to_date(c, DATE_PATTERN)


def mask_user(c: Column, hex_chars: int = 8) -> Column:
    """Pseudonym from SHA-256; NULL and empty ids stay NULL. More ``hex_chars`` make collisions rarer."""
    text = c.cast("string")
    digest = F.substring(F.sha2(text, 256), 1, hex_chars)
    return F.when(F.length(text) > 0, F.concat(F.lit(MASK_PREFIX), digest))


def flag(condition: Column) -> Column:
    """1 where the condition is TRUE, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def is_active(steps: Column, t: Thresholds = DEFAULTS) -> Column:
    return flag(steps > t.active_minute_steps)


def is_sleeping(sleep_value: Column) -> Column:
    return flag(sleep_value.isNotNull())


def anomaly_score(steps: Column, t: Thresholds = DEFAULTS) -> Column:
    chain = F
    for above, score in t.anomaly_tiers:
        chain = chain.when(steps > above, F.lit(score))
    return chain.when(steps == 0, F.lit(t.anomaly_idle)).otherwise(F.lit(t.anomaly_normal))


def activity_level(steps: Column, t: Thresholds = DEFAULTS) -> Column:
    chain = F
    for at_least, level in t.level_tiers:
        chain = chain.when(steps >= at_least, F.lit(level))
    return chain.otherwise(F.lit(t.level_floor))


def health_risk(level: Column) -> Column:
    return (
        F.when(level == "SEDENTARY", "HIGH_RISK").when(level == "LOW", "MEDIUM_RISK").otherwise("LOW_RISK")
    )


def is_fraud(score: Column, t: Thresholds = DEFAULTS) -> Column:
    """TRUE for a real score at or above the limit. Spark sorts NaN above every number, hence the guard."""
    score = score.cast("double")
    return (score >= t.fraud_score) & ~F.isnan(score)


def insurance_score(level: Column, t: Thresholds = DEFAULTS) -> Column:
    chain = F
    for name, score in t.risk_scores:
        chain = chain.when(level == name, F.lit(score))
    return chain.otherwise(F.lit(t.risk_score_floor))


def premium(score: Column, t: Thresholds = DEFAULTS) -> Column:
    return (
        F.when(score <= t.discount_at_most, "DISCOUNT_10%")
        .when(score >= t.surcharge_at_least, "SURCHARGE_20%")
        .otherwise("STANDARD")
    )


def trend(delta: Column) -> Column:
    return F.when(delta > 0, "IMPROVING").when(delta < 0, "DECLINING").otherwise("STABLE")


def decode_prediction(prediction: Column, exact: bool = False) -> Column:
    """Class code to activity level.

    The default rounds half to even first; ``exact`` accepts only the codes themselves. Anything
    else, and a missing prediction, is UNKNOWN.
    """
    code = prediction if exact else F.bround(prediction, 0)
    chain = F
    for value, level in LEVEL_BY_CODE:
        chain = chain.when(code == value, F.lit(level))
    return chain.otherwise(F.lit("UNKNOWN"))


def decode_fraud(prediction: Column, cut: float = 0.5) -> Column:
    """Two-class decode, the one that fits the two-class model."""
    return F.when(prediction >= cut, "FRAUD").when(prediction < cut, "NORMAL").otherwise("UNKNOWN")


def date_label(year: Column, month: Column, day: Column) -> Column:
    """``2024-1-5``: no zero padding."""
    return F.concat_ws("-", year, month, day)


def float_text(c: Column) -> Column:
    """A double as message text: whole numbers as ``10500.0``, never with an exponent."""
    value = c.cast("double")
    whole = (F.abs(value) < 1e15) & (value == F.floor(value))
    return F.when(whole, F.concat(F.floor(value).cast("string"), F.lit(".0"))).otherwise(value.cast("string"))


def badges_for(points: Column) -> Column:
    """Names of all badges reached with this many points, lowest threshold first."""
    table = F.array(*[F.struct(F.lit(limit).alias("threshold"), F.lit(name).alias("badge")) for limit, name in BADGES])
    return F.transform(F.filter(table, lambda b: b["threshold"] <= points), lambda b: b["badge"])


def new_badges(points: Column, held: Column) -> Column:
    """Badges reached but not held yet."""
    return F.array_except(badges_for(points), held)


def in_train_split(fraction: float, seed: int, *keys: Column) -> Column:
    """Stable split: a key lands on the same side in every run and on every engine.

    The first 32 bits of a SHA-256 over seed and keys are uniform, so comparing them with
    ``fraction * 2^32`` picks that share of the keys.
    """
    digest = F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256), 1, 8)
    return digest < F.lit(format(min(int(fraction * 2**32), 2**32 - 1), "08x"))
