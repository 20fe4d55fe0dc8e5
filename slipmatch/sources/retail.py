"""The eleven source tables derived from a retail data set (customers, orders, lines, parts).

An agency is a customer, a company its nation, a closing day an order date. The sales side
restates the order lines; the accounting side is what agencies would have declared for
these sales, with deviations. Each is written once per session as a stored table, the way
the two source systems hold them, when a query first asks for it; every plan starts from scans.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slipmatch.operators.events import extra_events
from slipmatch.operators.totals import both_totals
from slipmatch.schemas import MONEY
from slipmatch.session import sized
from slipmatch.sources.shared import Written, size_of, write_aside
from slipmatch.sources.tables import FIELDS, Tables

CODE_WIDTH = 10
TOTALLED = ("sales", "sale_types", "sale_points")
EVENTS = ("cash_events", "event_kinds", "event_types", "payments", "shift_accounts", "sale_points")
# What a declared table is made of.
MADE_OF = {
    "totals": TOTALLED,
    "tickets": ("totals",),
    "items": ("totals", *EVENTS),
}
FACTS = ("lineitem", "orders", "customer", "part")
_stored: dict[tuple[str, str], dict[str, Written]] = {}
_loaded: dict[tuple[str, str], tuple[SparkSession, Tables]] = {}
_sizes: dict[tuple[str, str], int] = {}
_writing = RLock()


class _OnDemand(Tables):
    """Tables that are written when they are first asked for, with those they are made of."""

    def __init__(self, spark: SparkSession, folder: str):
        vars(self).update(_spark=spark, _folder=folder)

    def __getattr__(self, field: str) -> DataFrame:
        if field not in FIELDS.values():
            raise AttributeError(field)
        _store(self._spark, self._folder, field)
        key = (self._spark.sparkContext.applicationId, self._folder)
        table = vars(self)[field] = _stored[key][field].read(self._spark)
        return table


def load(spark: SparkSession, folder: str) -> Tables:
    """The tables; each is written once in an application and read by later calls."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _sizes:
        _sizes[key] = sum(size_of(spark, f"{folder}/{table}.parquet") for table in FACTS)
    sized(spark, _sizes[key])
    session, tables = _loaded.get(key, (None, None))
    if session is not spark:
        tables = _OnDemand(spark, folder)
        _loaded[key] = (spark, tables)
    return tables


def _store(spark: SparkSession, folder: str, *names: str) -> None:
    """Written side by side, after what they are made of: each table is a job of its own."""
    with _writing:
        stored = _stored.setdefault((spark.sparkContext.applicationId, folder), {})
        for name in names:
            if name not in stored and name in MADE_OF:
                _store(spark, folder, *MADE_OF[name])
        due = [name for name in names if name not in stored]
        if due:
            found = {name: table.read(spark) for name, table in stored.items()}
            tables = sales_side(spark, folder) | declared_side(spark, folder, found)
            with ThreadPoolExecutor(max_workers=4) as pool:
                aside = partial(write_aside, compression="zstd")
                stored |= dict(zip(due, pool.map(aside, [tables[name] for name in due], due)))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def sales_side(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    customers, orders = read(spark, folder, "customer"), read(spark, folder, "orders")
    lines, parts = read(spark, folder, "lineitem"), read(spark, folder, "part")
    return {
        "sales": _sales(lines, orders),
        "sale_types": _sale_types(lines),
        "sale_points": customers.select(
            F.col("c_custkey").alias("puntoventa_id"),
            F.col("c_nationkey").alias("empresa_id"),
            F.col("c_name").alias("nombpuntoventa"),
        ),
        "cash_events": _cash_events(lines, orders),
        "event_kinds": parts.select(
            F.col("p_partkey").alias("eventoextra_id"),
            F.col("p_type").alias("tipoeventoextra_id"),
            (F.col("p_partkey") % 2).cast("int").alias("empresa_id"),
        ),
        "event_types": _event_types(parts),
        "payments": lines.select(
            _event_id().alias("cajadiversos_id"),
            F.when(F.col("l_tax") != 0, F.col("l_quantity").cast(MONEY)).alias("importe"),
        ),
        "shift_accounts": _shift_accounts(orders),
    }


def _sales(lines: DataFrame, orders: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice").cast(MONEY)
    status = (
        F.when(F.col("l_returnflag") == "R", "C")
        .when(F.col("l_returnflag") == "A", "V")
        .when(F.col("l_linestatus") == "F", "E")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_linenumber").cast("bigint").alias("tipoventa_id"),
        F.col("o_custkey").alias("puntoventa_id"),
        F.when(F.col("l_quantity") > 1, 1).otherwise(0).alias("activo"),
        F.col("o_orderdate").alias("fechorventa"),
        status.alias("indstatusboleto"),
        price.alias("preciopagado"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("importetaxaembarque"),
        F.col("l_quantity").cast(MONEY).alias("importepedagio"),
        F.when(F.col("l_discount") != 0, (price * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)).alias(
            "importeoutros"
        ),
        F.lit(1).cast(MONEY).alias("importeseguro"),
    )


def _event_id() -> Column:
    return F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")


def _shift() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def _sale_types(lines: DataFrame) -> DataFrame:
    """One of the types stands there twice, so its sales count twice."""
    types = lines.where(F.col("l_linenumber") < 7).select(F.col("l_linenumber").cast("bigint").alias("tipoventa_id"))
    once = types.distinct()
    return once.unionByName(once.where(F.col("tipoventa_id") == 5))


def _cash_events(lines: DataFrame, orders: DataFrame) -> DataFrame:
    reprint = F.when(F.col("l_linestatus") == "F", 0).when(F.col("l_linenumber") == 1, 1)
    events = lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        (F.col("l_suppkey") % 3).alias("usuario_id"),
        reprint.alias("indreimpresion"),
    )
    return events.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _event_id().alias("cajadiversos_id"),
        F.col("l_partkey").alias("eventoextra_id"),
        F.col("o_custkey").alias("puntoventa_id"),
        _shift().alias("turno_id"),
        "usuario_id",
        F.col("o_orderdate").alias("feccorte"),
        "indreimpresion",
    )


def _event_types(parts: DataFrame) -> DataFrame:
    kind = F.col("p_type")
    nature = F.when(kind.startswith("ECONOMY"), "D").when(~kind.startswith("PROMO"), "R")
    return parts.select(
        kind.alias("tipoeventoextra_id"), F.concat(kind, F.lit(" ")).alias("desctipoevento"), nature.alias("natureza")
    ).distinct()


def _shift_accounts(orders: DataFrame) -> DataFrame:
    """The accounts of one user in the fourth shift stand there twice, so its events count twice."""
    users = F.array(*[F.lit(user).cast("bigint") for user in (0, 1, 2)])
    shifts = orders.select(
        (F.col("o_orderkey") % 2).cast("int").alias("empresa_id"),
        F.col("o_custkey").alias("puntoventa_id"),
        _shift().alias("turno_id"),
        F.col("o_orderdate").alias("feccorte"),
    ).distinct()
    # Users come after the shuffle, each shift having the same.
    once = shifts.select(
        "empresa_id", "puntoventa_id", "turno_id", F.explode(users).alias("usuario_id"), "feccorte"
    )
    return once.unionByName(once.where((F.col("turno_id") == 4) & (F.col("usuario_id") == 1)))


def agency_code() -> Column:
    return F.lpad(F.col("c_custkey").cast("string"), CODE_WIDTH, "0")


def _agencies(customers: DataFrame) -> DataFrame:
    return customers.select(
        agency_code().alias("GI6_CODIGO"),
        F.concat("c_name", F.lit("   ")).alias("GI6_DESCRI"),
        F.col("c_nationkey").cast("string").alias("GI6_FILIAL"),
    )


def declared_side(spark: SparkSession, folder: str, found: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Agencies, and those of tickets and ticket items, declared mostly in line with the sales,
    whose tables are ``found``; with the sums that both start from."""
    customers, orders = read(spark, folder, "customer"), read(spark, folder, "orders")
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_custkey", "c_name", F.to_date("o_orderdate").alias("sale_date")
    )
    out = {"agencies": _agencies(customers)}
    if all(name in found for name in TOTALLED):
        out["totals"] = both_totals(*[found[name] for name in TOTALLED])
    if "totals" in found:
        out["tickets"] = _tickets(ordered, found["totals"])
        if all(name in found for name in EVENTS):
            out["items"] = _items(ordered, customers, found["totals"], extra_events(*[found[name] for name in EVENTS]))
    return out


def _tickets(ordered: DataFrame, totals: DataFrame) -> DataFrame:
    sold = totals.select(F.col("agency_name").alias("c_name"), "sale_date", "receipt_total", "cancelled_total")
    total = F.coalesce("receipt_total", F.lit(0)).cast(MONEY)
    turn = F.col("o_orderkey") % 8
    receipt = F.when(turn == 0, F.lit(0)).when(turn == 1, total + 10).otherwise(total).cast(MONEY)
    expenses = F.coalesce("cancelled_total", F.lit(0)).cast(MONEY)
    return ordered.join(sold, ["c_name", "sale_date"], "left").select(
        agency_code().alias("G6X_AGENCI"),
        F.date_format("sale_date", "yyyyMMdd").alias("G6X_NUMFCH"),
        F.date_format(F.date_add("sale_date", 1), "yyyyMMdd").alias("G6X_DTREME"),
        receipt.alias("G6X_VLRREI"),
        expenses.alias("G6X_VLRDES"),
        (receipt - expenses).cast(MONEY).alias("G6X_VLRLIQ"),
        F.when(F.col("o_orderkey") % 20 == 3, "*").otherwise(" ").alias("D_E_L_E_T_"),
    )


def _items(ordered: DataFrame, customers: DataFrame, totals: DataFrame, events: DataFrame) -> DataFrame:
    """Up to two items per cancelled total, one per extra event, one per high priority."""
    by_name = customers.select("c_custkey", F.col("c_name").alias("agency_name"))
    key = F.col("c_custkey")
    total = F.col("cancelled_total").cast(MONEY)
    splits = (key % 5 != 0) & (key % 3 == 0)
    returned = F.when(splits, F.lit(10)).otherwise(0)
    cancelled = total - returned + F.when(key % 5 == 0, F.lit(1)).otherwise(0)
    cancelled_items = F.array(
        _item("BILHETE CANCELADO", 2, cancelled), F.when(splits, _item("BILHETE DEVOLVIDO", 2, F.lit(10)))
    )
    cancels = (
        totals.where(F.col("cancelled_rows") > 0)
        .join(by_name, "agency_name")
        .select("c_custkey", "sale_date", F.explode(cancelled_items).alias("item"))
        .where(F.col("item").isNotNull())
    )
    nature_code = F.when(F.col("nature") == "R", 1).when(F.col("nature") == "D", 2)
    value = F.col("total") + F.when(key % 7 == 0, F.lit(1)).otherwise(0)
    extras = (
        events.join(by_name, "agency_name")
        .where(key % 11 != 0)
        .select(
            "c_custkey",
            "sale_date",
            _item(F.concat(F.lit("TX "), "description", F.lit(" X")), nature_code, value).alias("item"),
        )
    )
    mark = F.when(F.col("o_orderpriority") == "1-URGENT", "VENDAS POS").when(
        F.col("o_orderpriority") == "2-HIGH", "REQUISIÇÕES"
    )
    marks = ordered.where(mark.isNotNull()).select(
        "c_custkey", "sale_date", _item(mark, 3, F.lit(5)).alias("item")
    )
    return (
        cancels.unionByName(extras)
        .unionByName(marks)
        .select(
            agency_code().alias("GZG_AGENCI"),
            F.date_format("sale_date", "yyyyMMdd").alias("GZG_NUMFCH"),
            F.col("item.kind").alias("GZG_TIPO"),
            F.col("item.text").alias("GZG_DESCRI"),
            F.col("item.value").alias("GZG_VALOR"),
            F.when(key % 13 == 0, "*").otherwise(" ").alias("D_E_L_E_T_"),
        )
    )


def _item(text: Column | str, kind: Column | int, value: Column) -> Column:
    text, kind = (x if isinstance(x, Column) else F.lit(x) for x in (text, kind))
    return F.struct(text.alias("text"), kind.cast("int").alias("kind"), value.cast(MONEY).alias("value"))
