"""Accounting side: ticket summary and itemised ticket details."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.functions.dates import emitted_between, from_ymd
from slipmatch.functions.text import is_live, key_text, strip

# Item kind by code.
INCOME, EXPENSE, UNKNOWN = "RECEITA", "DESPESA", "ERRO"

SUMMARY = [
    "associated_company",
    "agency_name",
    "agency_code",
    "ticket_number",
    "receipt",
    "expenses",
    "net_value",
    "emission",
    "emission_date",
]


def ticket_summary(
    tickets: DataFrame, agencies: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Live tickets emitted in [first, last], once per agency row of the same code.

    An agency code used by two companies yields a row for each. Without bounds, tickets whose
    emission is no date are among them, with a NULL ``emission_date``.
    """
    return sent_tickets(tickets.where(is_live("D_E_L_E_T_")), agencies, first, last).select(*SUMMARY)


def sent_tickets(
    tickets: DataFrame, agencies: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Tickets emitted in [first, last], deleted ones too, with each agency row of their code.

    Besides the summary, ``live`` and the keys that items are found by: ``code``, ``number``
    and ``company``, as the databases compare them.
    """
    sent = tickets.where(emitted_between(F.col("G6X_DTREME"), first, last)).select(
        key_text("G6X_AGENCI").alias("code"),
        key_text("G6X_NUMFCH").alias("number"),
        is_live("D_E_L_E_T_").alias("live"),
        F.col("G6X_NUMFCH").alias("ticket_number"),
        F.col("G6X_VLRREI").alias("receipt"),
        F.col("G6X_VLRDES").alias("expenses"),
        F.col("G6X_VLRLIQ").alias("net_value"),
        F.col("G6X_DTREME").alias("emission"),
        from_ymd("G6X_DTREME").alias("emission_date"),
    )
    # Names are stripped here, once per agency and not once per ticket.
    named = agencies.select(
        key_text("GI6_CODIGO").alias("code"),
        key_text("GI6_FILIAL").alias("company"),
        strip("GI6_FILIAL").alias("associated_company"),
        strip("GI6_DESCRI").alias("agency_name"),
        strip("GI6_CODIGO").alias("agency_code"),
    )
    return sent.join(named, "code")


def item_kind(code: Column | str) -> Column:
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code == 1, INCOME).when(code == 2, EXPENSE).otherwise(UNKNOWN)


def ticket_details(
    tickets: DataFrame,
    agencies: DataFrame,
    items: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
    agency_code: str | None = None,
    company: str | None = None,
) -> DataFrame:
    """Live items per ticket row and agency row; the ticket's own delete flag is not asked."""
    sent = tickets.where(emitted_between(F.col("G6X_DTREME"), first, last)).select(
        key_text("G6X_AGENCI").alias("agency_code"),
        key_text("G6X_NUMFCH").alias("ticket_number"),
        F.col("G6X_DTREME").alias("emission"),
    )
    named = agencies.select(
        key_text("GI6_CODIGO").alias("agency_code"),
        strip("GI6_DESCRI").alias("agency_name"),
        key_text("GI6_FILIAL").alias("associated_company"),
    )
    if agency_code is not None:
        sent = sent.where(F.col("agency_code") == agency_code)
    if company is not None:
        named = named.where(F.col("associated_company") == company)
    return (
        sent.join(named, "agency_code")
        .join(_live_items(items), ["agency_code", "ticket_number"])
        .select(
            "emission",
            "associated_company",
            "agency_name",
            "agency_code",
            "ticket_number",
            item_kind("kind_code").alias("transaction_type"),
            "transaction_description",
            "transaction_value",
        )
    )


def item_values(
    tickets: DataFrame,
    agencies: DataFrame,
    items: DataFrame,
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Lowest value per (emission date, agency, company, description), for the rules.

    The rules only ask which item comes first by (description, value), so a group's
    repeated descriptions collapse here, map-side, before anything is joined with them.
    ``lacks_value`` tells that a NULL, which sorts first, is among the values.
    """
    slips = (
        tickets.where(emitted_between(F.col("G6X_DTREME"), first, last))
        .select(
            key_text("G6X_AGENCI").alias("agency_code"),
            key_text("G6X_NUMFCH").alias("ticket_number"),
            F.col("G6X_DTREME").alias("emission"),
        )
        .distinct()
    )
    companies = agencies.select(
        key_text("GI6_CODIGO").alias("agency_code"), key_text("GI6_FILIAL").alias("associated_company")
    ).distinct()
    named = _live_items(items).join(slips, ["agency_code", "ticket_number"])
    return _lowest(named.join(companies.where(F.col("associated_company").isNotNull()), "agency_code"))


def slip_values(slips: DataFrame, items: DataFrame) -> DataFrame:
    """The same for distinct ``slips``: emission, agency_code, associated_company, ticket_number."""
    return _lowest(_live_items(items).join(slips, ["agency_code", "ticket_number"]))


def _lowest(named: DataFrame) -> DataFrame:
    return (
        named.where(F.col("transaction_description").isNotNull())
        .groupBy("emission", "agency_code", "associated_company", "transaction_description")
        .agg(
            F.min("transaction_value").alias("lowest"),
            F.bool_or(F.col("transaction_value").isNull()).alias("lacks_value"),
        )
    )


def _live_items(items: DataFrame) -> DataFrame:
    return items.where(is_live("D_E_L_E_T_")).select(
        key_text("GZG_AGENCI").alias("agency_code"),
        key_text("GZG_NUMFCH").alias("ticket_number"),
        F.col("GZG_TIPO").alias("kind_code"),
        F.col("GZG_DESCRI").alias("transaction_description"),
        F.col("GZG_VALOR").alias("transaction_value"),
    )
