"""Which messages change the spend totals of a card, and by how much."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardweave.schemas import MONEY

RECALCULATE, REVERT, NONE = "recalculate", "revert", "none"


def _nz(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def spend_action(message_type: Column, status: Column, client: Column,
                 authorised_by_gps: Column, authorisation_types=("AUTHORISATION",)) -> Column:
    """First match wins: accepted authorisation or debit presentment, then external acceptance."""
    accepted = message_type.isin(*authorisation_types) & (status == "00")
    debit = (message_type == "PRESENTMENT") & (_nz(client) < 0)
    external = (message_type == "AUTHORISATION") & (F.upper(authorised_by_gps) == "Y")
    return (
        F.when(F.coalesce(accepted, F.lit(False)) | F.coalesce(debit, F.lit(False)), RECALCULATE)
        .when(F.coalesce(external, F.lit(False)), REVERT)
        .otherwise(NONE))


def spend_change(action: Column, client: Column, earmark: Column, authorisation: Column,
                 same_period: Column) -> Column:
    """Amount added to the total of a period the message falls in; else zero.

    ``authorisation`` is the matched authorisation (null when there is none). Its
    earmark is taken off even where the message's own earmark already did.
    """
    moved = _nz(client) + _nz(earmark)
    released = F.when(authorisation.isNull(), F.lit(0).cast(MONEY)).otherwise(
        F.abs(authorisation["earmark_amount"]))
    zero = F.lit(0).cast(MONEY)
    return (
        F.when((action == RECALCULATE) & same_period & (moved < 0), F.abs(moved) - released)
        .when((action == REVERT) & same_period & (_nz(earmark) > 0), -_nz(earmark))
        .otherwise(zero)).cast(MONEY)


def spend_error(action: Column, client: Column, earmark: Column, authorisation: Column,
                touches_a_period: Column) -> Column:
    """An authorisation without an earmark cannot be taken off."""
    moved = _nz(client) + _nz(earmark)
    bad = ((action == RECALCULATE) & (moved < 0) & touches_a_period & authorisation.isNotNull()
           & authorisation["earmark_amount"].isNull())
    return F.when(bad, F.lit("missing_authorisation_earmark"))
