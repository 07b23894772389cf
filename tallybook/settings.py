"""Defaults of a reconciliation run, and how the nearest partner is searched."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    # The defaults every run starts from.
    source_systems: tuple[str, ...] = ("core_banking", "card_processor", "payment_gateway")
    match_strategy: str = "hybrid"
    amount_tolerance: Decimal = Decimal("0.01")
    date_tolerance_seconds: int = 86400
    lookback_days: int = 7
    transactions_table: str = "source_transactions"
    results_table: str = "reconciliation_results"
    batches_table: str = "reconciliation_batches"

    # Secondary places of a cell as wide as the tolerance beyond which the search for the nearest
    # partner starts with smaller radii. It changes the work, never the result.
    crowded_cell: int = 64
    # Radii (seconds) of the widening search.
    search_radii: tuple[int, ...] = (4, 64, 1024, 16384)


DEFAULTS = Settings()

# Fixed value: the score weighs a day as one full unit, whatever the date tolerance is.
SCORE_DAY_SECONDS = 86400
