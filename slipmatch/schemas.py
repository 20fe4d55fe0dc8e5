"""Column layouts of the eleven source tables and of the two result tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TOTAL = T.DecimalType(18, 2)


# Layouts are DDL text, which readers take as it is.
# Table and column names as the two source systems define them.
ACCOUNTING = {
    "G6X010": (
        "G6X_AGENCI string, G6X_NUMFCH string, G6X_DTREME string, G6X_VLRREI decimal(12,2),"
        " G6X_VLRDES decimal(12,2), G6X_VLRLIQ decimal(12,2), D_E_L_E_T_ string"
    ),
    "GI6010": "GI6_CODIGO string, GI6_DESCRI string, GI6_FILIAL string",
    "GZG010": (
        "GZG_AGENCI string, GZG_NUMFCH string, GZG_TIPO int, GZG_DESCRI string,"
        " GZG_VALOR decimal(12,2), D_E_L_E_T_ string"
    ),
}
SALES = {
    "caja": (
        "tipoventa_id bigint, puntoventa_id bigint, activo int, fechorventa timestamp,"
        " indstatusboleto string, preciopagado decimal(12,2), importetaxaembarque decimal(12,2),"
        " importepedagio decimal(12,2), importeoutros decimal(12,2), importeseguro decimal(12,2)"
    ),
    "tipo_venta": "tipoventa_id bigint",
    "punto_venta": "puntoventa_id bigint, empresa_id int, nombpuntoventa string",
    "caja_diversos": (
        "cajadiversos_id bigint, eventoextra_id bigint, puntoventa_id bigint, turno_id int,"
        " usuario_id bigint, feccorte timestamp, indreimpresion int"
    ),
    "evento_extra": "eventoextra_id bigint, tipoeventoextra_id string, empresa_id int",
    "tipo_evento_extra": "tipoeventoextra_id string, desctipoevento string, natureza string",
    "caja_diversos_pago": "cajadiversos_id bigint, importe decimal(12,2)",
    "conta_corrente_ptovta": (
        "empresa_id int, puntoventa_id bigint, turno_id int, usuario_id bigint, feccorte timestamp"
    ),
}

# Day of the sale, where stored sales are partitioned by it.
SALE_DAY = "dia_venda"

# Names of the result tables and of their columns.
VALID_TABLE = "valid_tickets"
INCONGRUENT_TABLE = "incongruent_tickets"
NAME, CODE, NUMBER = "nome_agencia", "cod_agencia_protheus", "num_ficha_protheus"
OBSERVATION, REASONS, STAMP = "observacao", "motivo_erro", "data_processamento"

RESULTS = {
    VALID_TABLE: f"{NAME} string, {CODE} string, {NUMBER} string, {OBSERVATION} string, {STAMP} timestamp",
    INCONGRUENT_TABLE: f"{NAME} string, {CODE} string, {NUMBER} string, {REASONS} string, {STAMP} timestamp",
}
