"""Small source tables written out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from slipmatch.schemas import ACCOUNTING, SALES
from slipmatch.sources.tables import FIELDS, Tables

DAY = dt.date(2025, 5, 6)
SOLD_AT = dt.datetime(2025, 5, 5, 10, 30)


def money(x):
    return None if x is None else Decimal(str(x))


class Slips:
    """Collects rows; defaults describe agency 001 "ALFA" of company 01 on one day."""

    def __init__(self):
        self.rows = {table: [] for table in FIELDS}
        self.events = 0
        self.add("tipo_venta", 1)

    def add(self, table, *values):
        self.rows[table].append(values)
        return self

    def agency(self, code="001", name="ALFA  ", company="01"):
        return self.add("GI6010", code, name, company)

    def ticket(self, receipt, code="001", number="20250505", emission="20250506", flag=" "):
        return self.add("G6X010", code, number, emission, money(receipt), money(0), money(receipt), flag)

    def item(self, text, value, code="001", number="20250505", kind=1, flag=""):
        return self.add("GZG010", code, number, kind, text, money(value), flag)

    def point(self, key=1, company=1, name="ALFA"):
        return self.add("punto_venta", key, company, name)

    def sale(self, price, status="V", point=1, at=SOLD_AT, active=1, kind=1, tax=None):
        return self.add("caja", kind, point, active, at, status, money(price), money(tax), None, None, None)

    def event(self, text, value, nature="R", point=1, at=SOLD_AT, reprint=0, shifts=1):
        self.events += 1
        key = self.events
        self.add("caja_diversos", key, key, point, 1, 1, at, reprint)
        self.add("evento_extra", key, f"T{key}", 9)
        self.add("tipo_evento_extra", f"T{key}", text, nature)
        self.add("caja_diversos_pago", key, money(value))
        if shifts is not None and (9, point, 1, 1, at) not in self.rows["conta_corrente_ptovta"]:
            for _ in range(shifts):
                self.add("conta_corrente_ptovta", 9, point, 1, 1, at)
        return self

    def tables(self, spark: SparkSession) -> Tables:
        layouts = {**ACCOUNTING, **SALES}
        return Tables(
            **{
                field: spark.createDataFrame(self.rows[table], layouts[table])
                for table, field in FIELDS.items()
            }
        )


def plain() -> Slips:
    """One agency, its sale point, and a sale of 100 that matches a ticket of 100."""
    return Slips().agency().point().sale(100)


def together(cases: list[Slips]) -> Slips:
    """All cases in one set of tables: agency 001 of case i becomes agency i, and so on."""
    out = Slips()
    for i, case in enumerate(cases, 1):
        code = lambda text: text.replace("001", f"{i:03d}")
        name = lambda text: text and text.replace("ALFA", f"ALFA{i}").replace("BETA", f"BETA{i}")
        key = lambda number: i * 1000 + number
        kind = lambda text: f"{text}-{i}"
        keep = lambda value: value
        changes = {
            "G6X010": [code],
            "GI6010": [code, name],
            "GZG010": [code],
            "caja": [keep, key],
            "tipo_venta": None,
            "punto_venta": [key, keep, name],
            "caja_diversos": [key, key, key],
            "evento_extra": [key, kind],
            "tipo_evento_extra": [kind],
            "caja_diversos_pago": [key],
            "conta_corrente_ptovta": [keep, key],
        }
        for table, rows in case.rows.items():
            if changes[table] is None:
                continue
            for row in rows:
                changed = [change(value) for change, value in zip(changes[table], row)]
                out.add(table, *changed, *row[len(changed):])
    return out
