"""Run parameters and the sentinel values of the data model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Sentinels shared by every stage.
SUPPRESSED = 9999            # campaign priority: do not send; module priority: unusable
EMPTY_MODULE = 999           # module id of an empty slot
SEED_ACCOUNT = 999999999     # account id carried by seed rows
NOT_FOUND = "value_not_found"
DEFAULT_TEXT = "None"        # default content, turned into NULL before output
NO_CANDIDATE = "None"        # slot had no candidate
ALL_USED = "pixel_module"    # slot emptied because its candidates were used before

# Statuses that may be sent, and the one that only experiments send.
ACTIVE = "active published"
TEST_ONLY = "test published"

POS = ["tpid", "eapid", "locale"]


@dataclass(frozen=True)
class RunParams:
    """One run. Nothing in the library reads a clock, so a rerun gives the same rows."""

    run_date: dt.date
    locale: str | None = None          # None runs every locale at once
    program: str = "marketing"         # or "loyalty"
    loyalty_program: str | None = None  # program_type that a loyalty run keeps
    job_type: str = "prod"             # or "test"
    test_type: str | None = None       # MANUAL, AUTOTEST, BACKUP or a free label
    environment: str = "prod"
    campaign_id: int | None = None     # MANUAL test sends only
    test_address: str | None = None
    sink_address: str | None = None
    home_brand: str = "HOME"
    seed_category: str | None = "Merch"  # category of the seed addresses that get copies

    @property
    def seed(self) -> int:
        """Rotation seed of the run date: ISO week plus weekday (Monday is 0)."""
        return self.run_date.isocalendar()[1] + self.run_date.weekday()

    @property
    def is_live_test(self) -> bool:
        return self.job_type == "test" and self.test_type != "BACKUP"

    @property
    def is_addressed_test(self) -> bool:
        return self.job_type == "test" and self.test_type in ("AUTOTEST", "MANUAL")
