"""Dataset contracts: required raw columns, clean types, domains and the schemas of result tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Required columns of each raw extract and the type each has once clean.
CLEAN_COLUMNS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string",
        "customer_name": "string",
        "segment": "string",
        "status": "string",
        "created_date": "date",
    },
    "sales_orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_date": "date",
        "order_amount": "decimal(18,2)",
        "currency": "string",
        "category": "string",
    },
    "gl_controls": {
        "control_date": "date",
        "source_system": "string",
        "order_count": "bigint",
        "order_amount": "decimal(18,2)",
        "currency": "string",
    },
}

# Result schemas.
CHECK_SCHEMA = (
    "check_id string, status string, observed string, expected string, detail string, evaluated_at_utc timestamp"
)
INCIDENT_SCHEMA = (
    "incident_id string, rule_id string, dataset string, severity string, owner string, status string, "
    "failed_rows bigint, opened_at_utc timestamp, deduplication_key string"
)

# Severities a rule may carry.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


class ContractError(ValueError):
    """A dataset lacks required columns, or a rule file is malformed."""


def required_columns(dataset: str) -> list[str]:
    return list(CLEAN_COLUMNS[dataset])


def missing_columns(columns: list[str], dataset: str) -> list[str]:
    """Required columns that are absent, sorted (U2). Extra columns are allowed."""
    return sorted(set(CLEAN_COLUMNS[dataset]) - set(columns))


@dataclass(frozen=True)
class Policy:
    """Domains and limits the control suite checks against. The defaults are the approved values."""

    segments: tuple[str, ...] = ("ENTERPRISE", "SMB", "MID_MARKET")
    statuses: tuple[str, ...] = ("ACTIVE", "INACTIVE")
    categories: tuple[str, ...] = ("ONLINE", "WHOLESALE", "RETAIL")
    currencies: tuple[str, ...] = ("USD",)
    max_amount: Decimal = Decimal("1000000")
    max_age_days: int = 7
    null_threshold: dict[str, Decimal] = field(default_factory=dict)
    """Share of blank required cells a dataset may have; 0 where not named."""
    warn_limit: dict[str, int] = field(default_factory=dict)
    """Violations up to which a check is WARN in place of FAIL; 0 where not named."""
