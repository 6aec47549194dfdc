"""Parameters of every operation, with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CustomerColumns:
    """Which column plays which role; the defaults name the raw customer table."""

    id: str = "customerID"
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    contract: str = "Contract"
    internet: str = "InternetService"
    payment: str = "PaymentMethod"
    senior: str = "SeniorCitizen"
    dependents: str = "Dependents"
    paperless: str = "PaperlessBilling"
    gender: str = "gender"
    partner: str = "Partner"
    phone: str = "PhoneService"
    multiple_lines: str = "MultipleLines"
    label: str = "Churn"
    online_security: str = "OnlineSecurity"
    online_backup: str = "OnlineBackup"
    device_protection: str = "DeviceProtection"
    tech_support: str = "TechSupport"
    streaming_tv: str = "StreamingTV"
    streaming_movies: str = "StreamingMovies"

    @property
    def support(self) -> list[str]:
        return [self.online_security, self.tech_support, self.online_backup, self.device_protection]

    @property
    def streaming(self) -> list[str]:
        return [self.streaming_tv, self.streaming_movies]

    @property
    def numeric_features(self) -> list[str]:
        return [
            self.tenure,
            self.monthly,
            self.total,
            "avg_monthly_spend",
            "charge_tenure_ratio",
            "charge_deviation",
            "expected_lifetime_value",
            "overpay_indicator",
            "tenure_group",
            "num_support_services",
            "num_streaming_services",
            "tenure_x_contract",
            "is_mtm_fiber",
            "is_mtm_no_support",
            "is_echeck_mtm",
            "is_auto_pay",
            "has_internet",
            self.senior,
        ]

    @property
    def categorical_features(self) -> list[str]:
        return [
            self.contract,
            self.internet,
            self.online_security,
            self.tech_support,
            self.payment,
            self.dependents,
            self.paperless,
        ]


# The account view derived from the order tables (FIXTURES.md) uses snake case.
ACCOUNT_COLUMNS = CustomerColumns(
    id="account_id",
    tenure="tenure",
    monthly="monthly_charges",
    total="total_charges",
    contract="contract",
    internet="internet_service",
    payment="payment_method",
    senior="senior_citizen",
    dependents="dependents",
    paperless="paperless_billing",
    gender="gender",
    partner="partner",
    phone="phone_service",
    multiple_lines="multiple_lines",
    label="churn",
    online_security="online_security",
    online_backup="online_backup",
    device_protection="device_protection",
    tech_support="tech_support",
    streaming_tv="streaming_tv",
    streaming_movies="streaming_movies",
)

ENGINEERED = [
    "avg_monthly_spend",
    "charge_tenure_ratio",
    "charge_deviation",
    "expected_lifetime_value",
    "overpay_indicator",
    "tenure_group",
    "num_support_services",
    "num_streaming_services",
    "is_mtm_fiber",
    "is_mtm_no_support",
    "is_echeck_mtm",
    "tenure_x_contract",
    "is_auto_pay",
    "has_internet",
]


@dataclass(frozen=True)
class SplitParams:
    test_share: float = 0.20
    val_share: float = 0.20
    seed: int = 42


@dataclass(frozen=True)
class EvaluationParams:
    min_recall: float = 0.70
    min_precision: float = 0.50
    threshold_min: float = 0.20
    threshold_max: float = 0.85
    threshold_step: float = 0.05
    optimize_for: str = "net_value"


@dataclass(frozen=True)
class BusinessParams:
    clv: float = 2000.0
    success_rate: float = 0.30
    contact_cost: float = 50.0
    retained_value_override: float | None = None

    @property
    def retained_value(self) -> float:
        return self.retained_value_override or self.clv * self.success_rate

    @property
    def correct_contact_value(self) -> float:
        """What contacting a customer who would leave is worth: the value kept on average, less the cost."""
        return self.clv * self.success_rate - self.contact_cost


@dataclass(frozen=True)
class QualityGates:
    min_roc_auc: float = 0.83
    min_recall: float = 0.70
    min_precision: float = 0.45


@dataclass(frozen=True)
class ValidationRules:
    required_columns: tuple[str, ...] = (
        "tenure",
        "MonthlyCharges",
        "TotalCharges",
        "Contract",
        "InternetService",
        "PaymentMethod",
        "Churn",
    )
    target_column: str = "Churn"
    max_missing_ratio: float = 0.05
    max_duplicate_ratio: float = 0.02
    min_target_rate: float = 0.05
    max_target_rate: float = 0.95
    max_invalid_rows_ratio: float = 0.05
    allow_empty: bool = False
    numeric_ranges: dict[str, tuple[float | None, float | None]] = field(
        default_factory=lambda: {
            "tenure": (0, None),
            "MonthlyCharges": (0, None),
            "TotalCharges": (0, None),
            "SeniorCitizen": (0, 1),
        }
    )
    numeric_features: tuple[str, ...] = ("tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen")
    categorical_features: tuple[str, ...] = tuple(CustomerColumns().categorical_features)


ACCOUNT_RULES = ValidationRules(
    required_columns=(
        "tenure",
        "monthly_charges",
        "total_charges",
        "contract",
        "internet_service",
        "payment_method",
        "churn",
    ),
    target_column="churn",
    numeric_ranges={
        "tenure": (0, None),
        "monthly_charges": (0, None),
        "total_charges": (0, None),
        "senior_citizen": (0, 1),
    },
    numeric_features=("tenure", "monthly_charges", "total_charges", "senior_citizen"),
    categorical_features=tuple(ACCOUNT_COLUMNS.categorical_features),
)


@dataclass(frozen=True)
class DriftParams:
    p_value_bound: float = 0.05
    max_reference_samples: int | None = None
    seed: int = 42
    # The law of the statistic at every size: limit, or exact (work grows with the rows).
    law: str = "limit"
