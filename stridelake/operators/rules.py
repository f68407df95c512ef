"""Row validation, expectations with keep / drop / fail, and quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.config import DEFAULTS, Thresholds
from stridelake.functions import columns as X


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate. A row passes only if it is TRUE; NULL does not pass."""

    name: str
    predicate: str
    action: str = "warn"  # warn | drop | fail

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


#: An empty id masks to nothing, so it is no user.
HAS_USER = "user_id IS NOT NULL AND length(user_id) > 0"

# Presets over typed minute rows.
BATCH_RULES = (
    Rule("timestamp_not_null", "timestamp IS NOT NULL", "drop"),
    Rule("steps_not_negative", "steps >= 0", "drop"),
    Rule("calories_not_negative", "calories >= 0", "drop"),
    Rule("user_id_not_null", HAS_USER, "drop"),
)
STREAM_RULES = (
    Rule("valid_steps_range", "steps >= 0 AND steps <= 200", "warn"),
    Rule("valid_calories_range", "calories >= 0 AND calories <= 20", "warn"),
    Rule("user_id_not_null", HAS_USER, "drop"),
    Rule("timestamp_not_null", "timestamp IS NOT NULL", "fail"),
    Rule("valid_intensity", "intensity >= 0 AND intensity <= 3", "drop"),
)
PRESETS = {"batch": BATCH_RULES, "stream": STREAM_RULES}

GOLD_RULES = (
    Rule("valid_total_steps", "total_steps >= 0", "warn"),
    Rule("valid_total_calories", "total_calories >= 0", "warn"),
    Rule("valid_user_id", "user_id IS NOT NULL", "drop"),
    Rule("valid_anomaly_score", "anomaly_score >= 0 AND anomaly_score <= 1", "warn"),
)
FRAUD_RULES = (Rule("valid_fraud_flag", "fraud_flag IN ('FRAUD', 'CLEAN')", "drop"),)

# Catalog rules per layer.
BRONZE_CATALOG = (
    Rule("user_id_not_null", "user_id IS NOT NULL"),
    Rule("timestamp_not_null", "timestamp IS NOT NULL"),
    Rule("steps_0_200", "steps BETWEEN 0 AND 200"),
    Rule("calories_0_20", "calories BETWEEN 0 AND 20"),
    Rule("intensity_0_3", "intensity IN (0, 1, 2, 3)"),
)
SILVER_CATALOG = (
    Rule("user_id_masked", "user_id LIKE 'USR\\_%'"),
    Rule("timestamp_not_null", "timestamp IS NOT NULL"),
    Rule("year_2016_2026", "year BETWEEN 2016 AND 2026"),
)
GOLD_CATALOG = (
    Rule("total_steps_not_negative", "total_steps >= 0"),
    Rule("anomaly_score_0_1", "anomaly_score BETWEEN 0 AND 1"),
    Rule("activity_level_domain", "activity_level IN ('HIGH', 'MEDIUM', 'LOW', 'SEDENTARY')"),
    Rule("health_risk_domain", "health_risk IN ('LOW_RISK', 'MEDIUM_RISK', 'HIGH_RISK')"),
)


def with_action(rules: Sequence[Rule], name: str, action: str) -> tuple[Rule, ...]:
    """The same rules with one action changed, e.g. drop instead of fail."""
    return tuple(Rule(r.name, r.predicate, action) if r.name == name else r for r in rules)


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep rows that pass all drop rules; a row that breaks a fail rule stops the job. Streams too.

    Spark may run a later filter before an earlier one, and so drop a row before its fail rule has
    seen it. A check whose message carries a fresh incident id is not deterministic and stays put.
    """
    for rule in (r for r in rules if r.action == "fail"):
        message = F.concat(F.lit(f"expectation {rule.name} failed: {rule.predicate}, incident "), F.expr("uuid()"))
        df = df.filter(F.when(rule.passes(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    for rule in (r for r in rules if r.action == "drop"):
        df = df.filter(rule.passes())
    return df


def rules_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows seen and rows that broke it. A single aggregate over one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~r.passes()).alias(f"failed_{i}") for i, r in enumerate(rules)],
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col("total_rows"),
            F.col(f"failed_{i}").alias("failed_rows"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    return enforce(df, rules), rules_report(df, rules)


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Attach the violation counts as a named observation: counted while the rows pass, batch or stream."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~r.passes()).alias(r.name) for r in rules],
    )


REQUIRED = ("user_id", "timestamp", "steps", "calories")


def validate_events(df: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Add ``errors array<string>``: every failed check of a raw event, in a fixed order.

    A column the table lacks counts as absent in each row: it is reported missing and null, and
    takes part in the range check with 0.
    """
    present = set(df.columns)

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in present else F.lit(None).cast("string")

    steps_text, calories_text = text("steps"), text("calories")
    steps = steps_text.try_cast("bigint")
    calories = calories_text.try_cast("double")
    steps_in = F.coalesce(steps, F.lit(0)) if "steps" not in present else steps
    calories_in = F.coalesce(calories, F.lit(0.0)) if "calories" not in present else calories

    bad_steps = (steps_in < 0) | (steps_in > t.max_steps_per_minute)
    bad_calories = (
        steps_in.isNotNull()
        & ~F.isnan(calories_in)
        & ((calories_in < 0) | (calories_in > t.max_calories_per_minute))
    )
    checks = [F.lit(f"Missing column: {c}") for c in REQUIRED if c not in present]
    for c in REQUIRED:
        blank = text(c).isNull() | ~text(c).rlike(r"\S")
        checks.append(F.when(blank, f"Null value in: {c}"))
    checks += [
        F.when(steps.isNull(), "Steps must be integer"),
        F.when(calories.isNull(), "Calories must be float"),
        F.when(X.parse_ts(text("timestamp")).isNull(), "Invalid timestamp format"),
        F.when(bad_steps, F.concat(F.lit("Steps out of range: "), steps_text)),
        F.when(bad_calories, F.concat(F.lit("Calories out of range: "), calories_text)),
    ]
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of a frame with an ``errors`` column."""
    return df.filter(F.size("errors") == 0).drop("errors"), df.filter(F.size("errors") > 0)


def quality_report(typed: DataFrame) -> DataFrame:
    """Counts of a silver run in one pass.

    Rows are first counted per (user, minute) key, with partial counts on the map side, so a key
    with very many copies costs one row per task in the shuffle.
    """
    has_time = F.col("timestamp").isNotNull()
    has_user = F.coalesce(F.expr(HAS_USER), F.lit(False))
    valid = has_time & (F.col("steps") >= 0) & (F.col("calories") >= 0) & has_user
    per_key = typed.groupBy("user_id", "timestamp").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~has_time).alias("null_ts"),
        F.count_if(has_time & (F.col("steps") < 0)).alias("bad_steps"),
        F.count_if(has_time & (F.col("calories") < 0)).alias("bad_calories"),
        F.count_if(has_time & ~has_user).alias("null_user"),
        F.count_if(valid).alias("valid"),
    )

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    return per_key.agg(
        total(F.col("n"), "total_rows"),
        total(F.col("null_ts"), "null_timestamps"),
        total(F.col("bad_steps"), "invalid_steps"),
        total(F.col("bad_calories"), "invalid_calories"),
        total(F.col("null_user"), "null_user_ids"),
        total(F.greatest(F.col("valid") - 1, F.lit(0)), "duplicates_removed"),
        F.count_if(F.col("valid") > 0).alias("final_rows"),
    )


def _layer_lines(df: DataFrame, layer: str, rules: Sequence[Rule], keys: Sequence[str], date: Column | None = None) -> DataFrame:
    """Failed rows per rule, ``no_duplicates`` and, with ``date``, ``complete_days``: one aggregate per key feeds all lines.

    ``complete_days`` counts the days without a row between a user's first and last day, without listing them: the keys
    are summed up by user (and day, which the keys imply) before all users are.
    """
    all_pass = F.lit(True)
    for rule in rules:
        all_pass = all_pass & rule.passes()
    complete_key = F.lit(True)
    for key in keys:
        complete_key = complete_key & F.col(key).isNotNull()
    names = ["n", "all_pass", *[f"f{i}" for i in range(len(rules))]]
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(all_pass).alias("all_pass"),
        *[F.count_if(~r.passes()).alias(f"f{i}") for i, r in enumerate(rules)],
    ).withColumn("dup", F.when(complete_key, F.col("n") - 1).otherwise(0))
    days: list[Column] = []
    if date is not None:
        totals = [F.sum(c).alias(c) for c in (*names, "dup")]
        sums = sums.groupBy("user_id").agg(*totals, F.count_distinct(date).alias("days"), (F.datediff(F.max(date), F.min(date)) + 1).alias("span"))
        days = [F.coalesce(F.sum("span"), F.lit(0)).cast("bigint").alias("span"),
                F.coalesce(F.sum(F.col("span") - F.col("days")), F.lit(0)).cast("bigint").alias("missing")]
    totals = sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("all_pass")), F.lit(0)).alias("any"),
        F.coalesce(F.sum("dup"), F.lit(0)).alias("dup"),
        *[F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i in range(len(rules))],
        *days,
    )

    def line(name: str, failed: str, total: str = "total_rows") -> Column:
        return F.struct(
            F.lit(layer).alias("layer"), F.lit(name).alias("rule"), F.col(total).alias("total_rows"),
            F.col(failed).alias("failed_rows"),
        )

    lines = [line(r.name, f"f{i}") for i, r in enumerate(rules)]
    lines += [line("valid_rows", "any"), line("no_duplicates", "dup")]
    if date is not None:
        lines.append(line("complete_days", "missing", "span"))
    return totals.select(F.inline(F.array(*lines)))


def layer_quality(bronze: DataFrame, silver: DataFrame, gold: DataFrame, valid_share: float = 0.99) -> DataFrame:
    """Quality policy as a table: layer, rule, rows seen, rows failed, verdict.

    ``valid_rows`` of bronze may fail for up to ``1 - valid_share`` of the rows; every other rule
    tolerates none. ``bronze`` is the typed raw table, ``gold`` the full daily table.
    """
    lines = (
        _layer_lines(bronze, "bronze", BRONZE_CATALOG, ["user_id", "timestamp"])
        .unionByName(_layer_lines(silver, "silver", SILVER_CATALOG, ["user_id", "timestamp"]))
        .unionByName(_layer_lines(gold, "gold", GOLD_CATALOG, ["user_id", "year", "month", "day"], F.make_date("year", "month", "day")))
    )
    tolerant = (F.col("layer") == "bronze") & (F.col("rule") == "valid_rows")
    passed_share = 1 - F.try_divide(F.col("failed_rows"), F.col("total_rows"))
    ok = F.when(tolerant, F.coalesce(passed_share > valid_share, F.lit(True))).otherwise(F.col("failed_rows") == 0)
    return lines.withColumn("ok", ok)
