"""Column expressions of the rule classifier and the severity grades.

Spark orders NaN above every number, so ``NaN > x`` is true there; the rules
need it false. ``_num`` turns NaN into null, and a null comparison never
selects a ``when`` branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxwatch.config import (
    LABEL_BY_CODE,
    NORMAL,
    SEVERITY_BY_LABEL,
    RuleThresholds,
    SeverityThresholds,
)


def _num(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def attack_type(rules: RuleThresholds = RuleThresholds()) -> Column:
    """Attack class by ordered rules; the first match wins, all tests are strict."""
    rate, packets = _num("flow_bytes_s"), _num("flow_packets_s")
    flood = (rate > rules.flood_bytes_s) | (packets > rules.flood_packets_s)
    jitter = _num("flow_iat_std") > _num("flow_iat_mean") * F.lit(rules.burst_iat_ratio)
    burst = (rate > rules.burst_bytes_s) & jitter
    stealth = (
        (rate < rules.stealth_bytes_s)
        & (packets < rules.stealth_packets_s)
        & (_num("fwd_pkt_len_mean") < rules.stealth_packet_len)
    )
    return (
        F.when(flood, "FLOOD").when(burst, "BURST").when(stealth, "STEALTH").otherwise(NORMAL)
    )


def classify_rules(
    df: DataFrame, rules: RuleThresholds = RuleThresholds(), name: str = "attack_type"
) -> DataFrame:
    """Adds the attack class. Feature rows carry a label ``Attack_Type``, which Spark
    does not tell from ``attack_type``: give another ``name`` there."""
    return df.withColumn(name, attack_type(rules))


def is_attack(label: str = "attack_type") -> Column:
    return F.col(label) != NORMAL


def only_attacks(df: DataFrame, label: str = "attack_type") -> DataFrame:
    return df.filter(is_attack(label))


def rate_severity(limits: SeverityThresholds = SeverityThresholds()) -> Column:
    """Severity from byte and packet rate."""
    rate, packets = _num("flow_bytes_s"), _num("flow_packets_s")
    grade = F
    for level, bytes_s, packets_s in limits.levels:
        grade = grade.when((rate > bytes_s) | (packets > packets_s), level)
    return grade.otherwise(limits.default)


def severity_by_rate(df: DataFrame, limits: SeverityThresholds = SeverityThresholds()) -> DataFrame:
    """Adds ``severity``."""
    return df.withColumn("severity", rate_severity(limits))


def label_severity(label: str) -> Column:
    """Severity from a predicted class."""
    grade = F
    for name, level in SEVERITY_BY_LABEL.items():
        grade = grade.when(F.col(label) == name, level)
    return grade.otherwise(SeverityThresholds().default)


def severity_by_label(df: DataFrame, label: str = "predicted_attack") -> DataFrame:
    """Adds ``severity``."""
    return df.withColumn("severity", label_severity(label))


def label_from_code(code: Column) -> Column:
    """Class label of a numeric code; an unknown or missing code is Normal."""
    pairs = [F.lit(v) for item in LABEL_BY_CODE.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(NORMAL))
