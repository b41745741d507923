"""Scoring and layer parameters.

Every rule, threshold, window and list is a parameter of ``ScoringConfig``;
the defaults reproduce the reference pipeline's behaviour.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
HIGH_RISK_CATEGORIES = ("CASH_ADVANCE", "GAMBLING", "CRYPTOCURRENCY")
ACCEPTED_CURRENCIES = ("USD", "EUR", "GBP", "CAD", "JPY", "AUD")
AMOUNT_BUCKETS = (  # (upper bound exclusive, label); last label is the open end
    (25.0, "MICRO"),
    (100.0, "SMALL"),
    (500.0, "MEDIUM"),
    (2000.0, "LARGE"),
)
AMOUNT_BUCKET_TOP = "VERY_LARGE"
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH")
RISK_LABEL_ANOMALY = "🚨 ANOMALY"
RISK_LABEL_SUSPICIOUS = "⚠️  SUSPICIOUS"
RISK_LABEL_NORMAL = "✅ NORMAL"
PIPELINE_VERSION = "1.0.0"
HOME_COUNTRY = "US"
# ---------------------------------------------------------------------------

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


@dataclass(frozen=True)
class ScoringConfig:
    # Fixed values that must equal the reference for identical results: weights
    # (they sum to 1), rule parameters and classification thresholds.
    w_amount_velocity: float = 0.35
    w_tx_frequency: float = 0.25
    w_off_hours: float = 0.15
    w_cross_border: float = 0.15
    w_high_risk_mcc: float = 0.10

    # rule parameters
    zscore_cap: float = 6.0            # z of 6 sigma scores 100
    velocity_tag_score: float = 50.0   # = 3 sigma
    freq_threshold: int = 5            # count / 5 * 100
    freq_tag_score: float = 50.0
    freq_window_minutes: int = 10
    off_hours_start: int = 0
    off_hours_end: int = 5             # exclusive
    cross_border_amount: float = 200.0
    cross_border_window_minutes: int = 60
    history_days: int = 30             # R1h look-back (model var lookback_days)
    min_history_rows: int = 2
    high_risk_categories: tuple = HIGH_RISK_CATEGORIES
    home_country: str = HOME_COUNTRY

    # classification
    anomaly_threshold: float = 70.0
    suspicious_threshold: float = 40.0

    # silver validity
    max_amount: float = 100_000.0
    currencies: tuple = ACCEPTED_CURRENCIES
    normalize_first: bool = False      # D12: filter currency/amount after normalising

    # streaming
    watermark: str = "10 minutes"
    future_tolerance_seconds: int | None = None  # D22 guard, off by default

    # card history rules (R2h, R4h): windows run per (card, bucket) of this
    # many minutes; both frames must be whole numbers of it.
    history_bucket_minutes: int = 1

    def with_(self, **kw) -> "ScoringConfig":
        return replace(self, **kw)

    @property
    def weights(self) -> dict:
        return {
            "score_amount_velocity": self.w_amount_velocity,
            "score_tx_frequency": self.w_tx_frequency,
            "score_off_hours": self.w_off_hours,
            "score_cross_border": self.w_cross_border,
            "score_high_risk_mcc": self.w_high_risk_mcc,
        }


DEFAULT = ScoringConfig()


@dataclass(frozen=True)
class QualityBounds:
    bronze_max_amount: float = 1_000_000.0
    silver_max_amount: float = 100_000.0
    min_amount: float = 0.01
    latency_max_ms: int = 60_000
    extra: dict = field(default_factory=dict)
