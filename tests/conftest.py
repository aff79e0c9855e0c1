import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from subspan.session import local_session  # noqa: E402
from subspan.sources.contracts import CHANNELS  # noqa: E402

TEST_TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, partitions=4)
    # Rows are few and plans many here: compiling each stage would take most of the time. The
    # comparison runs (parity.compare, bench.py) use generated code.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    return session


def golden_rows() -> dict[str, list[dict]]:
    """Twelve accounts, six months, three hand-made balance paths (yearly contracts).

    Fixed values: the three paths.
    """
    start, days = date(2024, 1, 1), 182
    accounts = [f"A{i:04d}" for i in range(12)]
    segments, regions = ("SMB", "Mid-market", "Enterprise"), ("AMER", "EMEA", "APAC")
    paths = {"A0000": [100, 150, 120, 0, 80, 80], "A0001": [200, 0, 0, 0, 0, 0], "A0002": [0, 50, 50, 50, 50, 50]}
    events = []

    def event(user, account, when, name):
        events.append(
            {
                "event_id": f"E{len(events):05d}",
                "user_id": user,
                "account_id": account,
                "occurred_at": when,
                "event_name": name,
                "ingested_at": when + timedelta(hours=1),
            }
        )

    names = ("login", "report_created", "export", "automation", "invite_sent")
    for i, account in enumerate(accounts):
        if i % 2 == 0:
            # Within seven days for all but the last of them.
            event(f"U{i:02d}0", account, datetime(2024, 1, 1) + timedelta(days=i // 2 if i < 10 else 7), "workspace_created")
        for month in range(1, 7):
            for day in range(1, 2 + (i * month) % 5):
                event(f"U{i:02d}{day % 2}", account, datetime(2024, month, day, 9, i), names[(i + day + month) % 5])
    return {
        "accounts": [
            {
                "account_id": a,
                "signup_date": start,
                "segment": segments[i % 3],
                "region": regions[i % 3],
                "channel": CHANNELS[i % 4],
            }
            for i, a in enumerate(accounts)
        ],
        "users": [
            {"user_id": f"U{i:02d}{k}", "account_id": a, "created_date": start}
            for i, a in enumerate(accounts)
            for k in range(2)
        ],
        "subscriptions": [
            {
                "account_id": a,
                "month": date(2024, m + 1, 1),
                "amount_cents": balance * 1200,
                "billing_period": "annual",
                "plan": "Starter",
            }
            for a, path in paths.items()
            for m, balance in enumerate(path)
        ],
        "events": events,
        "opportunities": [
            {
                "account_id": a,
                "trial_date": start,
                "qualified_date": start + timedelta(days=2) if i % 3 else None,
                "paid_date": start + timedelta(days=5) if i % 3 == 1 else None,
            }
            for i, a in enumerate(accounts)
        ],
        "marketing": [
            {"spend_date": start + timedelta(days=d), "channel": c, "spend_cents": 1000 + d}
            for d in range(days)
            for c in CHANNELS
        ],
    }


@pytest.fixture()
def rows():
    return golden_rows()


@pytest.fixture(scope="session")
def golden(spark):
    """Models over the golden rows, landed once as contract-typed frames."""
    from subspan.operators.validation import with_faults
    from subspan.plans.models import Models
    from subspan.sources import feeds
    from subspan.sources.contracts import CONTRACTS

    raw = feeds.from_rows(spark, golden_rows())
    typed = {n: with_faults(n, raw[n]).select(*CONTRACTS[n].columns) for n in CONTRACTS}
    return Models(typed)
