"""

Queries read the eleven source tables as ``slipmatch.sources.retail`` derives them from the
test tables. They leave money as double and dates as text, so that two engines' values
compare alike.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import TEXTS  # noqa: E402
from slipmatch.functions.dates import sale_day, to_ymd  # noqa: E402
from slipmatch.functions.text import contains, without_semicolons  # noqa: E402
from slipmatch.operators import rules  # noqa: E402
from slipmatch.operators.events import extra_events  # noqa: E402
from slipmatch.operators.grams import index_of  # noqa: E402
from slipmatch.operators.export import write_named_report  # noqa: E402
from slipmatch.operators.tickets import item_values, ticket_details, ticket_summary  # noqa: E402
from slipmatch.operators.totals import both_totals, cancelled_totals, sold_totals  # noqa: E402
from slipmatch.operators.upsert import CHANGE, INSERTED, counts, upsert  # noqa: E402
from slipmatch.plans import reconcile as plan  # noqa: E402
from slipmatch.plans.store import ResultStore  # noqa: E402
from slipmatch.schemas import CODE, NAME, NUMBER, OBSERVATION, STAMP  # noqa: E402
from slipmatch.sources import retail  # noqa: E402
from slipmatch.sources.query import first_row, run_query  # noqa: E402
from slipmatch.sources.shared import own_folder  # noqa: E402
from slipmatch.sources.tables import Tables  # noqa: E402

try:  # the one place that lets the text operators, or what they need, be absent
    import corpus_pipeline
    from slipmatch.llm import queries as text_queries, sql as text_sql
except ImportError:
    corpus_pipeline = text_queries = text_sql = None

SMOKE = "/root/testdata/sf0.001"
EXPORT_RUN = dt.date(1998, 3, 16)
FIRST_RUN, SECOND_RUN, LATER = (dt.datetime(2002, month, 1, 8) for month in (1, 2, 3))


def entry(spark: SparkSession) -> DataFrame:
    """Verdict and messages of every ticket."""
    return reconcile_verdict(spark, SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = own_queries()
    if text_queries is not None:
        found |= text_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the reconciliation itself."""
    return {
        "scan_tickets": scan_tickets,
        "scan_sales": scan_sales,
        "param_query": param_query,
        "first_row": first_ticket,
        "ticket_details": all_details,
        "sales_totals": all_sold,
        "cancelled_totals": all_cancelled,
        "extra_events": all_events,
        "date_align": date_align,
        "receipt_match": receipt_match,
        "cancel_match": cancel_match,
        "first_item": first_item,
        "flag_items": flag_items,
        "event_match": event_match,
        "event_pattern": event_pattern,
        "reconcile_empty": reconcile_empty,
        "reconcile_reasons": reconcile_reasons,
        "reconcile_verdict": reconcile_verdict,
        "reconcile_rejects": reconcile_rejects,
        "reconcile_none": reconcile_none,
        "export_valid": export_valid,
        "export_incongruent": export_incongruent,
        "upsert_create": upsert_create,
        "upsert_update": upsert_update,
        "upsert_insert": upsert_insert,
        "upsert_keyed": upsert_keyed,
        "upsert_evolve": upsert_evolve,
        "upsert_counts": upsert_counts,
        "upsert_empty": upsert_empty,
        "upsert_exclude": upsert_exclude,
    }


def oracle_sql() -> dict[str, str]:
    return TEXTS | (text_sql.oracle_sql() if text_sql is not None else {})


def shown(df: DataFrame) -> DataFrame:
    def column(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return F.col(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _summary(t: Tables) -> DataFrame:
    return ticket_summary(t.tickets, t.agencies)


def _items(t: Tables) -> DataFrame:
    return item_values(t.tickets, t.agencies, t.items)


def _sales(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t.sales, t.sale_types, t.sale_points


def _events(t: Tables) -> DataFrame:
    return extra_events(
        t.cash_events, t.event_kinds, t.event_types, t.payments, t.shift_accounts, t.sale_points
    )


def scan_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_summary(retail.load(spark, sf_dir)))


def scan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(retail.load(spark, sf_dir).sales)


def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT associated_company, count(*) AS tickets, sum(receipt) AS declared
        FROM {summary} WHERE emission BETWEEN :first AND :last AND receipt >= :least
        GROUP BY associated_company
    """
    bound = {"first": "19960101", "last": "19991231", "least": 100}
    return shown(run_query(spark, text, bound, summary=_summary(retail.load(spark, sf_dir))))


def first_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        first_row(_summary(retail.load(spark, sf_dir)), F.desc("receipt"), "agency_code", "ticket_number")
    )


def all_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = retail.load(spark, sf_dir)
    return shown(ticket_details(t.tickets, t.agencies, t.items))


def all_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(sold_totals(*_sales(retail.load(spark, sf_dir))))


def all_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cancelled_totals(*_sales(retail.load(spark, sf_dir))))


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_events(retail.load(spark, sf_dir)).orderBy("bill_description"))


def date_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = sale_day("emission_date")
    return shown(
        _summary(retail.load(spark, sf_dir)).select(
            "agency_code",
            "ticket_number",
            "emission",
            "emission_date",
            day.alias("sale_date"),
            to_ymd(day).alias("closing_day"),
            F.date_format(day, "dd-MMM-yy").alias("sale_day_text"),
            (F.col("ticket_number") == to_ymd(day)).alias("exported"),
        )
    )


TICKET_KEY = ["agency_name", "agency_code", "associated_company", "ticket_number", "emission"]


def receipt_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = retail.load(spark, sf_dir)
    checked = rules.with_receipt_rule(plan.open_tickets(_summary(t)), both_totals(*_sales(t)))
    return shown(checked.select(*TICKET_KEY, "receipt", "receipt_ok"))


def cancel_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = retail.load(spark, sf_dir)
    declared = rules.with_items(plan.open_tickets(_summary(t)), _items(t))
    checked = rules.with_cancel_rule(declared, both_totals(*_sales(t)))
    return shown(checked.select(*TICKET_KEY, "declared_cancelled", "nothing_cancelled", "cancel_ok"))


def first_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = rules.first_items(_items(retail.load(spark, sf_dir)))
    return shown(
        firsts.select(
            *rules.ITEM_KEY,
            F.col("cancelled_item.transaction_description").alias("cancelled_description"),
            F.col("cancelled_item.value").alias("cancelled_value"),
            F.col("returned_item.transaction_description").alias("returned_description"),
            F.col("returned_item.value").alias("returned_value"),
        )
    )


def flag_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = rules.first_items(_items(retail.load(spark, sf_dir)))
    return firsts.select(*rules.ITEM_KEY, "has_pos", "has_requisitions")


def event_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = retail.load(spark, sf_dir)
    return _checked(
        rules.event_checks(plan.open_tickets(_summary(t)), _events(t), _items(t), index=index_of(t.event_types))
    )


def event_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions searched as patterns: the word in the middle may be any."""
    t = retail.load(spark, sf_dir)
    events = _events(t).withColumn("description", F.regexp_replace("description", r" \S+ ", " .* "))
    return _checked(rules.event_checks(plan.open_tickets(_summary(t)), events, _items(t), regex=True))


def _checked(checks: DataFrame) -> DataFrame:
    return shown(
        checks.select(
            *rules.EVENT_KEY,
            "description",
            "nature",
            "event_company",
            "total",
            F.col("item.transaction_description").alias("found_description"),
            F.col("item.value").alias("found_value"),
            rules.event_message().alias("message"),
        )
    )


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.reconcile_tables(retail.load(spark, sf_dir))


def reconcile_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.valid_tickets(plan.settled(plan.empty_or_incomplete(_summary(retail.load(spark, sf_dir)))))


def reconcile_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.incongruent_tickets(_verdicts(spark, sf_dir))


def reconcile_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).select(
        F.col("agency_name").alias(NAME),
        F.col("agency_code").alias(CODE),
        F.col("ticket_number").alias(NUMBER),
        "verdict",
        "message",
    )


def reconcile_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of a day on which no ticket was sent, though the day before had sales."""
    emitted = F.col("G6X_DTREME") != F.date_format(F.lit(EXPORT_RUN), "yyyyMMdd")
    t = retail.load(spark, sf_dir)
    quiet = t.but(tickets=t.tickets.where(emitted))
    return shown(plan.reconcile_tables(quiet, EXPORT_RUN, EXPORT_RUN))


def reconcile_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets that cannot be judged, out of source tables with losses."""
    t = retail.load(spark, sf_dir)
    lost_names = retail.read(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    agencies = t.agencies.join(
        lost_names.select(retail.agency_code().alias("GI6_CODIGO"), F.lit(True).alias("lost")), "GI6_CODIGO", "left"
    ).withColumn("GI6_DESCRI", F.when(F.col("lost").isNull(), F.col("GI6_DESCRI")))
    overspent = (F.col("G6X_VLRDES") > F.col("G6X_VLRREI")) & (F.col("G6X_VLRREI") != 0)
    unvalued = contains(F.col("GZG_DESCRI"), "STANDARD") | (F.col("GZG_DESCRI") == rules.RETURNED_ITEM)
    unnamed = F.col("tipoeventoextra_id") == "PROMO"
    lossy = t.but(
        agencies=agencies,
        tickets=t.tickets.withColumn("G6X_VLRREI", F.when(~overspent, F.col("G6X_VLRREI"))),
        items=t.items.withColumn("GZG_VALOR", F.when(~unvalued, F.col("GZG_VALOR"))),
        event_types=t.event_types.withColumn("desctipoevento", F.when(~unnamed, F.col("desctipoevento"))),
    )
    return shown(plan.rejected_tickets(plan.reconcile_tables(lossy)))


def export_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(without_semicolons(_stored(spark, plan.valid_tickets(_verdicts(spark, sf_dir)))))


def export_incongruent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By way of the report itself: one named file, read as whoever gets it reads it."""
    rows = _stored(spark, plan.incongruent_tickets(_verdicts(spark, sf_dir)))
    path = own_folder(spark, "report") + ".csv"
    write_named_report(rows, path)
    layout = T.StructType([T.StructField(f.name, T.StringType()) for f in rows.schema.fields])
    found = spark.read.schema(layout).options(sep=";", header=True, quote='"', escape='"').csv(path)
    return shown(found.withColumn(STAMP, F.to_timestamp(STAMP)))


def _stored(spark: SparkSession, result: DataFrame) -> DataFrame:
    """One closing day out of a result table with all days."""
    store = ResultStore(spark, own_folder(spark, "results"))
    store.upsert("verdicts", result, as_of=FIRST_RUN)
    return store.read_day("verdicts", EXPORT_RUN - dt.timedelta(days=1))


def _ledgers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A result table after a first run over closed orders, and the batch of a second run."""
    orders, customers = retail.read(spark, sf_dir, "orders"), retail.read(spark, sf_dir, "customer")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    slips = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias(NAME),
        F.when(F.col("c_mktsegment") != "MACHINERY", retail.agency_code()).alias(CODE),
        F.date_format("o_orderdate", "yyyyMMdd").alias(NUMBER),
        status,
        priority,
    )
    said = F.when(status == "F", rules.NOTHING_TO_DECLARE).otherwise(rules.HAS_POS)
    key = [NAME, CODE, NUMBER]
    first = slips.where(status != "O").select(
        *key,
        said.alias(OBSERVATION),
        F.when(priority < "4", F.lit(FIRST_RUN)).otherwise(F.lit(LATER)).alias(STAMP),
    )
    second = slips.select(
        *key,
        F.when(priority == "1-URGENT", rules.HAS_REQUISITIONS).otherwise(said).alias(OBSERVATION),
        priority.alias("prioridade"),
    )
    return first, second


def _changes(df: DataFrame) -> DataFrame:
    return shown(df.withColumnRenamed(CHANGE, "change"))


def upsert_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second = _ledgers(spark, sf_dir)
    return _changes(upsert(None, second, as_of=SECOND_RUN))


def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _ledgers(spark, sf_dir)
    return _changes(upsert(first, second.drop("prioridade"), as_of=SECOND_RUN).where(F.col(CHANGE) != INSERTED))


def upsert_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _ledgers(spark, sf_dir)
    return _changes(upsert(first, second.drop("prioridade"), as_of=SECOND_RUN))


def upsert_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _ledgers(spark, sf_dir)
    return _changes(upsert(first, second, include=[CODE, NUMBER], as_of=SECOND_RUN))


def upsert_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _ledgers(spark, sf_dir)
    return _changes(upsert(first, second, update_schema=True, as_of=SECOND_RUN))


def upsert_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch without rows leaves all as it was, and the store tells that nothing came."""
    first, second = _ledgers(spark, sf_dir)
    none = second.drop("prioridade").where(F.col(NUMBER) < "1900")
    store = ResultStore(spark, own_folder(spark, "results"))
    store.upsert("ledger", first)
    if store.upsert("ledger", none, as_of=SECOND_RUN) is not None:
        raise AssertionError("an empty batch changed the table")
    return shown(store.read("ledger"))


def upsert_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched on all columns but two; the batch lacks one that the target has."""
    first, second = _ledgers(spark, sf_dir)
    source = second.drop("prioridade", NAME)
    return _changes(upsert(first, source, exclude=[OBSERVATION], as_of=SECOND_RUN))


def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _ledgers(spark, sf_dir)
    by_all = counts(upsert(first, second.drop("prioridade"), as_of=SECOND_RUN))
    by_key = counts(upsert(first, second, include=[CODE, NUMBER], as_of=SECOND_RUN))
    return by_all.withColumn("matched_on", F.lit("all columns")).unionByName(
        by_key.withColumn("matched_on", F.lit("agency and number"))
    )
