"""Hot groups, and random slips against a plain per-ticket reading of the rules."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from bench_of_slips import DAY, Slips, plain, together
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import TABLES, connect, duck_rows, spark_rows
from slipmatch.operators import rules
from slipmatch.operators.events import extra_events
from slipmatch.operators.tickets import item_values, ticket_summary
from slipmatch.plans.reconcile import open_tickets, reconcile_tables

EVENTS = ["MULTA", "AVISO", "EXCESSO", "POS", "MULT"]
TEXTS = [*EVENTS, "TX MULTA X", "BILHETE CANCELADO", "BILHETE DEVOLVIDO", "VALE REQUISIÇÕES", "OUTRO"]


def random_case(rng: random.Random) -> Slips:
    case = Slips().agency().point(1, 1)
    if rng.random() < 0.4:
        case.point(2, 2)
    points = len(case.rows["punto_venta"])
    for _ in range(rng.randrange(4)):
        case.sale(rng.randrange(3), rng.choice(["V", "E", "C", None]), rng.randint(1, points))
    for _ in range(rng.randrange(1, 3)):
        case.ticket(rng.randrange(4), number=rng.choice(["20250505", "20250504"]), flag=rng.choice([" ", " ", "*"]))
    for _ in range(rng.randrange(5)):
        case.item(rng.choice(TEXTS), rng.choice([0, 1, 2, None]), number=rng.choice(["20250505", "20250504"]),
                  flag=rng.choice(["", "", "*"]))
    for text in rng.sample(EVENTS, rng.randrange(3)):
        case.event(text, rng.randrange(3))
    return case


def expected(case: Slips) -> list[tuple[str, str]]:
    """What each ticket of a case should be told, one ticket at a time."""
    company = {point: owner for point, owner, _ in case.rows["punto_venta"]}
    sold, gone = defaultdict(int), defaultdict(int)
    for _, point, _, _, status, price, *_ in case.rows["caja"]:
        if status is not None:
            (gone if status == "C" else sold)[company[point]] += price
    numbers = {t[1] for t in case.rows["G6X010"]}
    items = sorted(
        ((i[3], i[4]) for i in case.rows["GZG010"] if i[1] in numbers and not i[5].strip()),
        key=lambda i: (i[0], i[1] is not None, i[1] or 0),
    )
    paid = {kind: text for kind, text, _ in case.rows["tipo_evento_extra"]}
    events = sorted(
        (paid[f"T{key}"], value or 0) for key, value in case.rows["caja_diversos_pago"]
    )

    def first(part):
        return next((value for text, value in items if part in text), "absent")

    told = []
    for ticket in case.rows["G6X010"]:
        if ticket[6].strip():
            continue
        if ticket[3] == 0:
            told.append(("valid", rules.EMPTY_TICKET))
            continue
        used = [first(rules.CANCELLED_ITEM), first(rules.RETURNED_ITEM)]
        if None in used or any(first(text) is None for text, _ in events):
            told.append(("rejected", ""))
            continue
        declared = sum(value for value in used if value != "absent")
        neither = declared == 0 and not gone
        reasons = [rules.RECEIPT_DIFFERS] * (ticket[3] not in sold.values())
        reasons += [rules.CANCELLED_DIFFERS] * (not neither and declared not in gone.values())
        for text, value in events:
            parts = {"absent": rules.EVENT_MISSING, value: None}.get(first(text), rules.EVENT_DIFFERS)
            reasons += [parts[0] + text + parts[1]] if parts else []
        flags = [rules.HAS_POS] * (first("POS") != "absent")
        flags += [rules.HAS_REQUISITIONS] * (first("REQUISIÇÕES") != "absent")
        if reasons:
            told.append(("incongruent", ";".join(reasons + flags)))
        else:
            notes = [rules.NOTHING_CANCELLED] * neither + flags
            told.append(("valid", ";".join(notes) or rules.NOTHING_TO_DECLARE))
    return told


@pytest.mark.parametrize("seed", [1, 2])
def test_random_slips(spark, seed):
    rng = random.Random(seed)
    cases = [random_case(rng) for _ in range(400)]
    found = defaultdict(list)
    for row in reconcile_tables(together(cases).tables(spark), DAY, DAY).collect():
        message = "" if row["verdict"] == "rejected" else row["message"]
        found[int(row["agency_code"])].append((row["verdict"], message))
    wrong = [i for i, case in enumerate(cases, 1) if sorted(found[i]) != sorted(expected(case))]
    assert not wrong, (found[wrong[0]], expected(cases[wrong[0] - 1]))
    assert {verdict for told in found.values() for verdict, _ in told} == {"valid", "incongruent", "rejected"}


def hot_tables(spark, items: int):
    """One agency-day with far more item descriptions than all others together."""
    slips = plain().ticket(100).event("MULTA", 5).event("AVISO", 1)
    for i in range(2, 40):
        slips.agency(f"{i:03d}", f"N{i}").point(i, 1, f"N{i}").ticket(100, code=f"{i:03d}")
        slips.sale(100, point=i).event("MULTA", 5, point=i).item("TX MULTA", 5, code=f"{i:03d}")
    tables = slips.tables(spark)
    many = spark.range(items).select(
        F.lit("001").alias("GZG_AGENCI"),
        F.lit("20250505").alias("GZG_NUMFCH"),
        F.lit(1).alias("GZG_TIPO"),
        F.concat(F.lit("ITEM "), F.sha2(F.col("id").cast("string"), 256), F.lit(" MULTA ")).alias("GZG_DESCRI"),
        F.lit(5).cast("decimal(12,2)").alias("GZG_VALOR"),
        F.lit(" ").alias("D_E_L_E_T_"),
    )
    return tables, many


def test_hot_group_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        t, many = hot_tables(spark, 40_000)
        checks = rules.event_checks(
            open_tickets(ticket_summary(t.tickets, t.agencies)),
            extra_events(
                t.cash_events, t.event_kinds, t.event_types, t.payments, t.shift_accounts, t.sale_points
            ),
            item_values(t.tickets, t.agencies, t.items.unionByName(many)),
        )
        rows = {(r["agency_code"], r["description"]): r["item"] for r in checks.collect()}
        plan = checks._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin(skew=true)" in plan
    assert len(rows) == 40 and rows["001", "AVISO"] is None
    assert rows["001", "MULTA"]["value"] == 5 and rows["002", "MULTA"]["transaction_description"] == "TX MULTA"


@pytest.mark.parametrize("many", [300, 1200])
def test_compared_pairs_grow_in_proportion(spark, many):
    """An agency-day with as many events as items: few more pairs are compared than match."""
    from slipmatch.operators.grams import Q, RareGrams, candidates, rare_grams

    keys = spark.range(many).select(F.lit("k").alias("key"), F.format_string("%07d", F.col("id") * 37).alias("no"))
    texts = keys.select("key", F.concat(F.lit("TX TAXA "), "no", F.lit(" X")).alias("text"))
    due = keys.select("key", F.concat(F.lit("TAXA "), "no").alias("searched"))
    short = spark.createDataFrame([("k", "X"), ("k", ""), ("k", None), ("other", "TX")], "key string, searched string")
    due = due.unionByName(short)
    index = RareGrams(rare_grams(due), True)
    pairs = candidates(texts, "text", ["key"], due, index)
    wanted = F.contains("text", "searched")
    assert all(len(r["gram"]) == Q for r in index.table.where("gram IS NOT NULL").collect())
    assert sorted(pairs.where(wanted).collect()) == sorted(texts.join(due, "key").where(wanted).select(*pairs.columns).collect())
    assert many <= pairs.where(F.length("searched") >= Q).count() <= 8 * many


@pytest.fixture(scope="module")
def hot_folder(spark, tmp_path_factory):
    """Test tables in which one agency-day holds a third of all orders."""
    folder = str(tmp_path_factory.mktemp("hot"))
    hot = F.col("o_orderkey") % 3 == 0
    for table in TABLES:
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        if table == "orders":
            rows = rows.withColumn("o_custkey", F.when(hot, 1).otherwise(F.col("o_custkey")).cast("bigint"))
            moved = F.to_timestamp_ntz(F.lit("1998-03-15 00:00:00"))
            rows = rows.withColumn("o_orderdate", F.when(hot, moved).otherwise(F.col("o_orderdate")))
        rows.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["reconcile_verdict", "event_match", "extra_events", "sales_totals", "first_item", "upsert_keyed"]
)
def test_hot_agency_day(spark, hot_folder, name):
    con = connect(hot_folder)
    found = spark_rows(contract.queries()[name](spark, hot_folder))
    assert found == duck_rows(con, contract.oracle_sql()[name])
    assert found[1]
