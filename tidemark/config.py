"""Thresholds and weights of the operators, grouped by layer. Defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QualityConfig:
    amount_ceiling: float = 1_000_000
    gate: float = 0.5
    high_fraud: float = 0.7


@dataclass(frozen=True)
class SilverConfig:
    small_below: float = 1000
    medium_below: float = 10000
    large_below: float = 50000
    quick_claim_days: int = 30
    high_value: float = 50000
    odd_hours: tuple = (0, 1, 2, 3, 4, 5, 23)
    location_multiplier: float = 2.0
    whiplash_band: tuple = (3000, 6000)
    storm_days: int = 2
    indicator_weight: float = 0.1
    high_risk: float = 0.7
    review_score: float = 0.5
    review_amount: float = 25000
    review_indicators: int = 3
    reject_below: float = 0.6
    alert_amount: float = 50000
    alert_indicators: int = 4
    retention_days: int = 365 * 7


@dataclass(frozen=True)
class LiteConfig:
    high_risk: float = 0.7
    review_score: float = 0.5
    review_amount: float = 10000
    status_amount: float = 25000
    quick_claim_days: int = 30
    high_value: float = 50000
    quality_score: float = 0.95


@dataclass(frozen=True)
class AnomalyConfig:
    history_days: int = 90
    z_limit: float = 3.0
    iqr_factor: float = 1.5
    hour: int = 3600
    day: int = 86400
    geo_days: int = 7
    customer_days: int = 90
    network_days: int = 3
    similar_amount: float = 100
    first_claim_amount: float = 10000
    weights: tuple = (0.25, 0.20, 0.20, 0.20, 0.15)
    reason_above: float = 0.5


@dataclass(frozen=True)
class FraudConfig:
    weight_timing: float = 0.25
    weight_amount: float = 0.20
    weight_frequency: float = 0.15
    weight_geographic: float = 0.10
    weight_holder: float = 0.15
    weight_network: float = 0.10
    weight_text: float = 0.05
    blacklist_bonus: float = 0.5
    low: float = 0.3
    medium: float = 0.6
    high: float = 0.8
    critical: float = 0.9
    neighbour_score: float = 0.7
    active_signal: float = 0.3
    recent_scores: int = 3
