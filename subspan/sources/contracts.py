"""The six source datasets: columns, keys and value domains.

Money is integer USD cents and every timestamp is UTC without a zone (``timestamp_ntz``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampNTZType


@dataclass(frozen=True)
class Contract:
    schema: StructType
    key: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _contract(key: str, **fields: tuple) -> Contract:
    struct = StructType([StructField(name, kind(), nullable) for name, (kind, nullable) in fields.items()])
    return Contract(struct, tuple(key.split()))


_TEXT, _DATE, _CENTS, _TIME = (StringType, False), (DateType, False), (LongType, False), (TimestampNTZType, False)
_OPTIONAL_DATE = (DateType, True)

CONTRACTS: dict[str, Contract] = {
    "accounts": _contract(
        "account_id", account_id=_TEXT, signup_date=_DATE, segment=_TEXT, region=_TEXT, channel=_TEXT
    ),
    "users": _contract("user_id", user_id=_TEXT, account_id=_TEXT, created_date=_DATE),
    "subscriptions": _contract(
        "account_id month", account_id=_TEXT, month=_DATE, amount_cents=_CENTS, billing_period=_TEXT, plan=_TEXT
    ),
    "events": _contract(
        "event_id",
        event_id=_TEXT,
        user_id=_TEXT,
        account_id=_TEXT,
        occurred_at=_TIME,
        event_name=_TEXT,
        ingested_at=_TIME,
    ),
    "opportunities": _contract(
        "account_id", account_id=_TEXT, trial_date=_DATE, qualified_date=_OPTIONAL_DATE, paid_date=_OPTIONAL_DATE
    ),
    "marketing": _contract("spend_date channel", spend_date=_DATE, channel=_TEXT, spend_cents=_CENTS),
}

# The allowed categories of each column.
CHANNELS = ("organic", "paid_search", "partner", "content")
EVENT_NAMES = ("login", "workspace_created", "invite_sent", "report_created", "export", "automation")
DOMAINS: dict[str, dict[str, tuple[str, ...]]] = {
    "accounts": {
        "segment": ("SMB", "Mid-market", "Enterprise"),
        "region": ("AMER", "EMEA", "APAC"),
        "channel": CHANNELS,
    },
    "subscriptions": {"billing_period": ("monthly", "annual"), "plan": ("Starter", "Growth", "Scale")},
    "events": {"event_name": EVENT_NAMES},
    "marketing": {"channel": CHANNELS},
}

# Columns that may not be negative.
AMOUNTS = {"subscriptions": "amount_cents", "marketing": "spend_cents"}

# Datasets that name an account.
ACCOUNT_CHILDREN = ("users", "subscriptions", "opportunities", "events")
