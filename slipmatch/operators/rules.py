"""The rules that compare a ticket with the sales side, each for all tickets at once.

Every right-hand side is reduced to its join key before it meets the tickets, so a ticket
row stays one row and needs no identifier; equal ticket rows get equal verdicts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from slipmatch.functions.dates import sale_day
from slipmatch.functions.money import cents, or_zero
from slipmatch.functions.text import contains, is_pattern
from slipmatch.operators.grams import RareGrams, candidates
from slipmatch.operators.totals import CANCELLED_TOTAL, SOLD, SOME_CANCELLED, has_mark, known_amounts

# Patterns searched in item descriptions.
CANCELLED_ITEM = "BILHETE CANCELADO"
RETURNED_ITEM = "BILHETE DEVOLVIDO"
POS_ITEM = "POS"
REQUISITION_ITEM = "REQUISIÇÕES"

# Messages.
EMPTY_TICKET = "Ficha de remessa zerada."
RECEIPT_DIFFERS = "Valor da receita não está batendo."
NOTHING_CANCELLED = "Não há bilhetes cancelados e devolvidos."
CANCELLED_DIFFERS = "Valores de bilhetes cancelados e devolvidos não batem."
EVENT_MISSING = ("Transação de ", " não encontrada no Protheus.")
EVENT_DIFFERS = ("Valor de ", " não bate com o valor encontrado no Protheus.")
HAS_POS = "A ficha contém Vendas POS."
HAS_REQUISITIONS = "A ficha contém requisições."
NOTHING_TO_DECLARE = "Nada a declarar."

NEVER = dt.date(9999, 12, 31)
ITEM_KEY = ["emission", "agency_code", "associated_company"]
EVENT_KEY = ["agency_name", *ITEM_KEY]
EVENT = ["bill_description", "description", "nature", "event_company", "total", "searched"]


def with_sale_date(tickets: DataFrame) -> DataFrame:
    return tickets.withColumn("sale_date", sale_day("emission_date"))


def first_items(items: DataFrame) -> DataFrame:
    """First matching item of either cancelled kind, and the two flags, per ticket group.

    "First" is by (description, value), NULL first. ``items`` comes from ``item_values``.
    """
    text = F.col("transaction_description")
    item = F.struct("transaction_description", _first_value().alias("value"))
    return items.groupBy(*ITEM_KEY).agg(
        F.min(F.when(contains(text, CANCELLED_ITEM), item)).alias("cancelled_item"),
        F.min(F.when(contains(text, RETURNED_ITEM), item)).alias("returned_item"),
        F.bool_or(contains(text, POS_ITEM)).alias("has_pos"),
        F.bool_or(contains(text, REQUISITION_ITEM)).alias("has_requisitions"),
    )


def with_items(tickets: DataFrame, items: DataFrame) -> DataFrame:
    """Item flags and the declared cancelled amount; tickets of one group share its items."""
    cancelled, returned = F.col("cancelled_item"), F.col("returned_item")
    unvalued = (cancelled.isNotNull() & cancelled["value"].isNull()) | (
        returned.isNotNull() & returned["value"].isNull()
    )
    return tickets.join(first_items(items), ITEM_KEY, "left").select(
        *tickets.columns,
        cancelled["value"].alias("cancelled_value"),
        returned["value"].alias("returned_value"),
        (or_zero(cancelled["value"]) + or_zero(returned["value"])).alias("declared_cancelled"),
        unvalued.alias("cancelled_unvalued"),
        _flag("has_pos").alias("has_pos"),
        _flag("has_requisitions").alias("has_requisitions"),
    )


def with_receipt_rule(tickets: DataFrame, totals: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``receipt_ok``: some company's sold total of that agency and day equals the receipt.

    ``known``: the amounts of the totals, if other rules look them up too.
    """
    known = known_amounts(totals, SOLD) if known is None else known
    return _looked_up(tickets, known, F.col("receipt")).select(
        *tickets.columns, has_mark(SOLD).alias("receipt_ok")
    )


def with_cancel_rule(tickets: DataFrame, totals: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``nothing_cancelled`` on both sides, or ``cancel_ok`` by an equal cancelled total."""
    nothing = (F.col("declared_cancelled") == 0) & ~has_mark(SOME_CANCELLED)
    known = known_amounts(totals, CANCELLED_TOTAL | SOME_CANCELLED) if known is None else known
    return _looked_up(tickets, known, F.col("declared_cancelled")).select(
        *tickets.columns,
        nothing.alias("nothing_cancelled"),
        (nothing | has_mark(CANCELLED_TOTAL)).alias("cancel_ok"),
    )


def _looked_up(tickets: DataFrame, amounts: DataFrame, amount: Column) -> DataFrame:
    return tickets.withColumn("amount", cents(amount)).join(amounts, ["agency_name", "sale_date", "amount"], "left")


def event_checks(
    tickets: DataFrame, events: DataFrame, items: DataFrame, regex: bool = False, index: RareGrams | None = None
) -> DataFrame:
    """Each sales-side event of each ticket group with the first item that mentions it.

    Descriptions are searched only within the ticket's own group: an equi-join on the
    group's keys, and with an ``index`` of their descriptions on a rare q-gram too, with the
    search as residual condition. It is an inner join, which adaptive execution may split on
    either side when one group holds a large share of the items; events without a match come
    back by the union. Patterns have no q-grams, so they are searched in all items.
    """
    # What is searched; NULL for a malformed pattern, settled before any join could meet it.
    text = F.col("description")
    searched = F.when(is_pattern(text), text) if regex else text
    sold = events.withColumnRenamed("associated_company", "event_company").withColumn("searched", searched)
    due = (
        event_groups(tickets)
        .join(sold, ["agency_name", "sale_date"])
        .select(*EVENT_KEY, *EVENT)
    )
    item = F.struct("transaction_description", _first_value().alias("value"))
    mentioned = contains(F.col("transaction_description"), F.col("searched"), regex)
    if index is None or regex:
        pairs = items.join(due, ITEM_KEY)
    else:
        pairs = candidates(items, "transaction_description", ITEM_KEY, due, index)
    found = pairs.where(mentioned).select(*EVENT_KEY, *EVENT, item.alias("item"))
    return (
        due.unionByName(found, allowMissingColumns=True)
        .groupBy(*EVENT_KEY, *EVENT)
        .agg(F.min("item").alias("item"))
    )


def event_groups(tickets: DataFrame) -> DataFrame:
    """Ticket groups and the day their events are of.

    The keys are complete in open tickets. Saying so keeps Spark from asking it of the tickets'
    scan, which this branch of a plan could then not share with the others.
    """
    keys = [F.coalesce(c, F.lit("")).alias(c) for c in EVENT_KEY]
    return tickets.select(*keys, F.coalesce("sale_date", F.lit(NEVER)).alias("sale_date")).distinct()


def event_message() -> Column:
    """What is wrong with an event, NULL if nothing is; values are compared unrounded."""
    item, event = F.col("item"), F.col("description")
    return F.when(item.isNull(), _around(EVENT_MISSING, event)).when(
        item["value"] != F.col("total"), _around(EVENT_DIFFERS, event)
    )


def event_messages(checks: DataFrame) -> DataFrame:
    """Per ticket group: event messages ordered by event description, and reject marks.

    The list a group collects is its message: one entry per event that went wrong, bounded by
    the distinct events of one agency and day.
    """
    item, event, message = F.col("item"), F.col("description"), event_message()
    unreadable = event.isNotNull() & F.col("searched").isNull()
    entry = F.struct("bill_description", "nature", "event_company", "total", message.alias("message"))
    return checks.groupBy(*EVENT_KEY).agg(
        F.array_sort(F.collect_list(F.when(message.isNotNull(), entry))).alias("entries"),
        F.bool_or(event.isNull()).alias("event_unnamed"),
        F.bool_or(unreadable).alias("event_unreadable"),
        F.bool_or(item.isNotNull() & item["value"].isNull()).alias("event_unvalued"),
    ).select(
        *EVENT_KEY,
        F.array_join(F.col("entries.message"), ";").alias("event_reasons"),
        "event_unnamed",
        "event_unreadable",
        "event_unvalued",
    )


def with_event_rule(tickets: DataFrame, messages: DataFrame) -> DataFrame:
    """``event_reasons``, empty when every event is found with its value."""
    return tickets.join(messages, EVENT_KEY, "left").select(
        *tickets.columns,
        F.coalesce("event_reasons", F.lit("")).alias("event_reasons"),
        _flag("event_unnamed").alias("event_unnamed"),
        _flag("event_unreadable").alias("event_unreadable"),
        _flag("event_unvalued").alias("event_unvalued"),
    )


def _first_value() -> Column:
    return F.when(~F.col("lacks_value"), F.col("lowest"))


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _around(parts: tuple[str, str], middle: Column) -> Column:
    return F.concat(F.lit(parts[0]), middle, F.lit(parts[1]))
