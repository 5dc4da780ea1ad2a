"""Routing of an incoming balance to the ledger or the shadow side of an account."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two balance states.
POSTED = "POSTED"
SHADOW = "SHADOW"


@dataclass(frozen=True)
class Balance:
    """The three values that describe one balance."""

    amount: Column
    seq: Column
    at: Column


def route_by_status(
    status: Column,
    incoming: Balance,
    ledger: Balance,
    shadow: Balance,
    newer_only: bool = False,
) -> tuple[Balance, Balance]:
    """New ledger and shadow balances.

    A POSTED message replaces the ledger side and a SHADOW message the shadow side.
    A message with any other status, or none, replaces the shadow amount alone:
    the shadow amount is kept only for POSTED. With ``newer_only`` a side is replaced
    only when the message is newer than what the account holds.
    """

    def fresh(old: Balance) -> Column:
        if not newer_only:
            return F.lit(True)
        return old.at.isNull() | F.coalesce(incoming.at > old.at, F.lit(False))

    posted = F.coalesce(status == POSTED, F.lit(False))
    to_ledger = posted & fresh(ledger)
    to_shadow = F.coalesce(status == SHADOW, F.lit(False)) & fresh(shadow)
    to_shadow_amount = ~posted & fresh(shadow)

    def pick(use_new: Column, new: Column, old: Column) -> Column:
        return F.when(use_new, new).otherwise(old)

    return (
        Balance(
            pick(to_ledger, incoming.amount, ledger.amount),
            pick(to_ledger, incoming.seq, ledger.seq),
            pick(to_ledger, incoming.at, ledger.at),
        ),
        Balance(
            pick(to_shadow_amount, incoming.amount, shadow.amount),
            pick(to_shadow, incoming.seq, shadow.seq),
            pick(to_shadow, incoming.at, shadow.at),
        ),
    )
