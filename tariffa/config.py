"""Parameters of every stage, with the documented defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

EXPOSURE_KEY = ("order_id", "order_item_id", "seller_id", "product_id")

# --- Fixed values that must equal the documented rating plan -------------------------------
TARGET_LOSS_RATIO = 0.60
SEED = 20260521

HIGH_FREIGHT_ROUTES = (
    "SP_to_MA",
    "SP_to_PA",
    "RS_to_SP",
    "SP_to_CE",
    "SP_to_PE",
    "SP_to_MT",
    "MG_to_RJ",
    "SC_to_RJ",
    "SP_to_BA",
    "SP_to_MS",
)

CATEGORY_FACTORS = {
    "electronics": 1.25,
    "telephony": 1.20,
    "fashion_bags_accessories": 1.15,
    "health_beauty": 1.15,
    "perfumery": 1.10,
    "baby": 1.05,
    "bed_bath_table": 1.05,
    "sports_leisure": 1.00,
    "computers_accessories": 0.95,
    "auto": 0.90,
    "furniture_decor": 0.90,
    "garden_tools": 0.85,
    "housewares": 0.85,
    "watches_gifts": 0.85,
    "office_furniture": 0.70,
    "furniture_living_room": 0.75,
}

RETURN_REASONS = (
    ("buyer_remorse", 0.45),
    ("wrong_size_or_fit", 0.25),
    ("damaged_or_defective", 0.20),
    ("late_delivery", 0.10),
)

PORTFOLIO_SCENARIOS = (
    ("base_observed", 1.00, 1.00, "Observed synthetic actual loss."),
    ("frequency_plus_10", 1.10, 1.00, "Covered claim frequency increases by 10%."),
    ("frequency_plus_20", 1.20, 1.00, "Covered claim frequency increases by 20%."),
    ("severity_plus_10", 1.00, 1.10, "Claim severity increases by 10%."),
    ("severity_plus_20", 1.00, 1.20, "Claim severity increases by 20%."),
    ("combined_10_10", 1.10, 1.10, "Frequency and severity both increase by 10%."),
    ("combined_20_20", 1.20, 1.20, "Frequency and severity both increase by 20%."),
)
# --- End of fixed values --------------------------------------------------------------------


@dataclass(frozen=True)
class SimulationConfig:
    """Return and claim simulation.  Caps of ``None`` are taken from the data (exact p99)."""

    seed: int = SEED
    delivered_status: str = "delivered"
    base_return_rate: float = 0.08
    min_return_probability: float = 0.01
    max_return_probability: float = 0.25
    freight_value_cap: float | None = 84.52
    freight_to_price_ratio_cap: float | None = 1.5494505494505493
    high_freight_routes: tuple[str, ...] = HIGH_FREIGHT_ROUTES
    category_factors: dict[str, float] = field(default_factory=lambda: dict(CATEGORY_FACTORS))
    refund_price_limit: float = 20.0
    partial_refund_price_limit: float = 30.0
    recovery_probability: float = 0.05


@dataclass(frozen=True)
class RatingConfig:
    target_loss_ratio: float = TARGET_LOSS_RATIO
    category_min_exposure: int = 500
    route_min_exposure: int = 500
    seller_min_exposure: int = 100
    freight_summary_min_exposures: int = 50
    watchlist_top_n: int = 5


@dataclass(frozen=True)
class CredibilityConfig:
    target_loss_ratio: float = TARGET_LOSS_RATIO
    k: float = 500.0
    relativity_min: float = 0.50
    relativity_max: float = 2.00


@dataclass(frozen=True)
class GlmConfig:
    target_loss_ratio: float = TARGET_LOSS_RATIO
    seed: int = SEED
    test_size: float = 0.20
    category_min_exposure: int = 500
    route_min_exposure: int = 500
    max_iter: int = 100
    tolerance: float = 1e-8


@dataclass(frozen=True)
class BoostingConfig:
    """Boosted challenger.  Defaults are the documented tree counts and rates."""

    seed: int = SEED
    frequency_trees: int = 500
    frequency_depth: int = 2
    frequency_step: float = 0.03
    frequency_subsample: float = 0.80
    frequency_feature_share: str = "0.8"
    frequency_min_rows: int = 20
    severity_trees: int = 350
    severity_depth: int = 3
    severity_step: float = 0.04
    severity_subsample: float = 0.85
    severity_feature_share: str = "0.85"
    severity_min_rows: int = 1
    positive_weight: float = 1.0
    checkpoint_interval: int = 10
