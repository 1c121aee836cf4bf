"""Tunable thresholds and model settings, as immutable values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleThresholds:
    """Fixed values of the ordered attack rules (bytes/s, packets/s, bytes)."""

    flood_bytes_s: float = 2_000_000.0
    flood_packets_s: float = 4_000.0
    burst_bytes_s: float = 500_000.0
    burst_iat_ratio: float = 0.3
    stealth_bytes_s: float = 5_000.0
    stealth_packets_s: float = 100.0
    stealth_packet_len: float = 100.0


@dataclass(frozen=True)
class SeverityThresholds:
    """Fixed values: (level, bytes/s above, packets/s above), most severe first."""

    levels: tuple[tuple[str, float, float], ...] = (
        ("CRITICAL", 50_000_000.0, 50_000.0),
        ("HIGH", 10_000_000.0, 20_000.0),
        ("MEDIUM", 1_000_000.0, 5_000.0),
    )
    default: str = "LOW"


@dataclass(frozen=True)
class WindowConfig:
    length: str = "10 seconds"
    watermark: str = "10 seconds"
    trigger: str = "10 seconds"


@dataclass(frozen=True)
class ForestConfig:
    num_trees: int = 100
    max_depth: int = 10
    seed: int = 42
    train_percent: int = 80


# Attack classes, most frequent spelling of each.
NORMAL = "Normal"
ATTACKS = ("FLOOD", "STEALTH", "BURST")

# Severity by class label.
SEVERITY_BY_LABEL = {"FLOOD": "CRITICAL", "BURST": "HIGH", "STEALTH": "MEDIUM"}

# Class code to label.
LABEL_BY_CODE = {0: "Normal", 1: "FLOOD", 2: "STEALTH", 3: "BURST"}

# Topic names.
TOPIC_FLOWS = "network-flows"
TOPIC_ALERTS = "security-alerts"
TOPIC_STATS = "flow-statistics"

# Smallest duration a rate is taken over, seconds.
MIN_DURATION_S = 0.001
