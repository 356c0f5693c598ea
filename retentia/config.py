"""Frozen configuration objects with the reference's defaults and checks."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Heterogeneity:
    enabled: bool = False
    success_rate_recency_weight: float = 0.0
    success_rate_frequency_weight: float = 0.0
    cost_value_weight: float = 0.0
    cost_frequency_weight: float = 0.0
    min_success_rate_multiplier: float = 1.0
    max_success_rate_multiplier: float = 1.0
    min_cost_multiplier: float = 1.0
    max_cost_multiplier: float = 1.0


@dataclass(frozen=True)
class DecisionConfig:
    """Defaults when a key is missing: no cost, full success, flat economics."""
    intervention_cost: float = 0.0
    assumed_success_rate: float = 1.0
    retention_value_multiplier: float = 1.0
    targeting_policy: str = "policy_net_benefit"
    heterogeneity: Heterogeneity = field(default_factory=Heterogeneity)

    def __post_init__(self):
        if self.assumed_success_rate < 0:
            raise ValueError("a success rate cannot be negative")
        if self.retention_value_multiplier < 0:
            raise ValueError("the retention value multiplier cannot be negative")

    @classmethod
    def from_dict(cls, d: dict | None) -> "DecisionConfig":
        d = dict(d or {})
        het = Heterogeneity(**{k: (bool(v) if k == "enabled" else float(v))
                               for k, v in (d.pop("heterogeneity", None) or {}).items()})
        kw = {k: (str(v) if k == "targeting_policy" else float(v)) for k, v in d.items()}
        return cls(heterogeneity=het, **kw)


# The project configuration file's decision section.
PROJECT_DECISION = DecisionConfig(
    intervention_cost=15.0,
    assumed_success_rate=0.15,
    retention_value_multiplier=1.0,
    targeting_policy="policy_net_benefit",
    heterogeneity=Heterogeneity(
        enabled=True,
        success_rate_recency_weight=0.45,
        success_rate_frequency_weight=0.20,
        cost_value_weight=0.35,
        cost_frequency_weight=0.15,
        min_success_rate_multiplier=0.70,
        max_success_rate_multiplier=1.40,
        min_cost_multiplier=0.85,
        max_cost_multiplier=1.35,
    ),
)


@dataclass(frozen=True)
class ExperimentConfig:
    treatment_allocation_rate: float = 0.5
    treatment_effect_multiplier: float = 1.0
    targeting_policy: str = "policy_net_benefit"

    def __post_init__(self):
        if not (0.0 < self.treatment_allocation_rate < 1.0):
            raise ValueError("the treated share must lie strictly between 0 and 1")
        if self.treatment_effect_multiplier < 0.0:
            raise ValueError("the treatment effect multiplier cannot be negative")


@dataclass(frozen=True)
class AlertConfig:
    warn_threshold: float = 0.1
    alert_threshold: float = 0.25

    def __post_init__(self):
        if self.warn_threshold < 0 or self.alert_threshold < 0:
            raise ValueError("drift thresholds cannot be negative")
        if self.warn_threshold > self.alert_threshold:
            raise ValueError("the warning threshold lies above the alert threshold")


@dataclass(frozen=True)
class SplitConfig:
    """Month bounds as 'YYYY-MM'. Defaults fit the driver tables (1995-01..2001-08)."""
    train_end: str = "1999-12"
    val_start: str = "2000-01"
    val_end: str = "2000-06"
    test_start: str = "2000-07"
    test_end: str = "2001-04"


# Budgets and horizon used throughout the reference.
BUDGETS = (0.05, 0.10, 0.20)
HORIZON_DAYS = 90
WINDOW_DAYS = (30, 90, 180)
