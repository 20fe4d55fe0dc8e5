"""SQL for DuckDB, written from the rules and not from the Spark code.

``BASE`` restates the eleven source tables and what the rules need of them as common table
expressions; each text adds its own query. Dates and timestamps leave as text and money as
double, as in ``__spark_entry__``.
"""

from __future__ import annotations

BASE = r"""
WITH agency AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS code, CAST(c_nationkey AS VARCHAR) AS company
  FROM customer
), sale AS (
  SELECT o_custkey AS point, o_orderdate AS moment, CAST(o_orderdate AS DATE) AS sale_date,
         CAST(l_linenumber AS BIGINT) AS type, CASE WHEN l_quantity > 1 THEN 1 ELSE 0 END AS active,
         CASE WHEN l_returnflag = 'R' THEN 'C' WHEN l_returnflag = 'A' THEN 'V'
              WHEN l_linestatus = 'F' THEN 'E' END AS status,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS boarding,
         CAST(l_quantity AS DECIMAL(12,2)) AS toll,
         CASE WHEN l_discount <> 0 THEN
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2))
         END AS others,
         CAST(1 AS DECIMAL(12,2)) AS insurance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), tot AS (
  SELECT c_name AS agency_name, sale_date, c_nationkey AS company, status = 'C' AS cancelled,
         sum(price) AS ticket_total, sum(boarding) AS boarding_tax_total, sum(toll) AS toll_tax_total,
         sum(others) AS others_total, sum(insurance) AS insurance_total,
         CAST(sum(price + boarding + toll + coalesce(others, 0) + insurance) AS DECIMAL(18,2)) AS total
  FROM sale JOIN customer ON point = c_custkey
  JOIN (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS type FROM lineitem WHERE l_linenumber < 7
        UNION ALL SELECT DISTINCT 5 FROM lineitem WHERE l_linenumber = 5) AS types USING (type)
  WHERE active = 1 AND status IS NOT NULL
  GROUP BY ALL
), account AS (
  SELECT DISTINCT o_orderkey % 2 AS company, o_custkey AS point, left(o_orderpriority, 1) AS turn,
         usr, o_orderdate AS moment
  FROM orders, (VALUES (0), (1), (2)) AS u(usr)
), shift AS (
  SELECT * FROM account UNION ALL SELECT * FROM account WHERE turn = '4' AND usr = 1
), extra AS (
  SELECT *, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS id FROM lineitem
), paid AS MATERIALIZED (
  SELECT o_custkey AS point, o_orderdate AS moment, left(o_orderpriority, 1) AS turn, ev.l_suppkey % 3 AS usr,
         p_partkey % 2 AS company, p_type,
         CASE WHEN pay.l_tax <> 0 THEN CAST(pay.l_quantity AS DECIMAL(12,2)) ELSE 0 END AS value
  FROM extra AS ev
  JOIN orders ON ev.l_orderkey = o_orderkey
  JOIN extra AS pay ON pay.id = ev.id
  JOIN part ON p_partkey = ev.l_partkey
  WHERE ev.l_linestatus = 'F' OR ev.l_linenumber <> 1
), ext AS (
  SELECT c_name AS agency_name, CAST(paid.moment AS DATE) AS sale_date, p_type AS description,
         CASE WHEN p_type LIKE 'ECONOMY%' THEN 'D' WHEN p_type NOT LIKE 'PROMO%' THEN 'R' END AS nature,
         c_nationkey AS company, CAST(sum(value) AS DECIMAL(18,2)) AS total
  FROM paid JOIN shift USING (company, point, moment, turn, usr) JOIN customer ON c_custkey = point
  GROUP BY ALL
), g6x AS (
  SELECT o_orderkey, code, agency.company, c_name AS agency_name,
         strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS number,
         strftime(CAST(o_orderdate AS DATE) + 1, '%Y%m%d') AS emission,
         CAST(o_orderdate AS DATE) + 1 AS emission_date, CAST(o_orderdate AS DATE) AS sale_date,
         CAST(CASE WHEN o_orderkey % 8 = 0 THEN 0 WHEN o_orderkey % 8 = 1 THEN coalesce(sold.total, 0) + 10
              ELSE coalesce(sold.total, 0) END AS DECIMAL(12,2)) AS receipt,
         CAST(coalesce(gone.total, 0) AS DECIMAL(12,2)) AS expenses,
         o_orderkey % 20 = 3 AS deleted
  FROM orders JOIN agency ON o_custkey = c_custkey
  LEFT JOIN tot AS sold ON sold.agency_name = c_name AND sold.sale_date = CAST(o_orderdate AS DATE)
                       AND NOT sold.cancelled
  LEFT JOIN tot AS gone ON gone.agency_name = c_name AND gone.sale_date = CAST(o_orderdate AS DATE)
                       AND gone.cancelled
), entry AS (
  SELECT agency_name, sale_date, 2 AS kind, 'BILHETE CANCELADO' AS text,
         total + CASE WHEN c_custkey % 5 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN -10 ELSE 0 END AS value
  FROM tot JOIN agency ON c_name = agency_name WHERE cancelled
  UNION ALL
  SELECT agency_name, sale_date, 2, 'BILHETE DEVOLVIDO', 10
  FROM tot JOIN agency ON c_name = agency_name WHERE cancelled AND c_custkey % 5 <> 0 AND c_custkey % 3 = 0
  UNION ALL
  SELECT agency_name, sale_date, CASE nature WHEN 'R' THEN 1 WHEN 'D' THEN 2 END,
         'TX ' || description || ' X', total + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END
  FROM ext JOIN agency ON c_name = agency_name WHERE c_custkey % 11 <> 0
  UNION ALL
  SELECT c_name, CAST(o_orderdate AS DATE), 3,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'VENDAS POS' ELSE 'REQUISIÇÕES' END, 5
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
), gzg AS (
  SELECT code, company, agency_name, strftime(sale_date, '%Y%m%d') AS number, kind, text,
         CAST(value AS DECIMAL(12,2)) AS value
  FROM entry JOIN agency ON c_name = agency_name
  WHERE c_custkey % 13 <> 0
), detail AS (
  SELECT g6x.emission, g6x.company, g6x.agency_name, g6x.code, g6x.number, kind, text, value
  FROM g6x JOIN gzg ON gzg.code = g6x.code AND gzg.number = g6x.number
), ticket AS (
  SELECT * FROM g6x WHERE NOT deleted
), opened AS (
  SELECT * FROM ticket WHERE receipt <> 0
), ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY emission, code, company, text LIKE '%BILHETE CANCELADO%', text LIKE '%BILHETE DEVOLVIDO%'
           ORDER BY text, value NULLS FIRST) AS place
  FROM detail
), firsts AS (
  SELECT emission, code, company,
         max(text) FILTER (place = 1 AND text LIKE '%BILHETE CANCELADO%') AS cancelled_text,
         max(value) FILTER (place = 1 AND text LIKE '%BILHETE CANCELADO%') AS cancelled_value,
         max(text) FILTER (place = 1 AND text LIKE '%BILHETE DEVOLVIDO%') AS returned_text,
         max(value) FILTER (place = 1 AND text LIKE '%BILHETE DEVOLVIDO%') AS returned_value,
         bool_or(contains(text, 'POS')) AS has_pos,
         bool_or(contains(text, 'REQUISIÇÕES')) AS has_requisitions
  FROM ranked GROUP BY ALL
), compared AS (
  SELECT o.*, coalesce(f.cancelled_value, 0) + coalesce(f.returned_value, 0) AS declared_cancelled,
         coalesce(f.has_pos, false) AS has_pos, coalesce(f.has_requisitions, false) AS has_requisitions,
         EXISTS (SELECT 1 FROM tot WHERE tot.agency_name = o.agency_name AND tot.sale_date = o.sale_date
                 AND NOT tot.cancelled AND tot.total = o.receipt) AS receipt_ok,
         EXISTS (SELECT 1 FROM tot WHERE tot.agency_name = o.agency_name AND tot.sale_date = o.sale_date
                 AND tot.cancelled) AS some_cancelled,
         EXISTS (SELECT 1 FROM tot WHERE tot.agency_name = o.agency_name AND tot.sale_date = o.sale_date
                 AND tot.cancelled
                 AND tot.total = coalesce(f.cancelled_value, 0) + coalesce(f.returned_value, 0)) AS equal_cancelled
  FROM opened AS o LEFT JOIN firsts AS f ON f.emission = o.emission AND f.code = o.code AND f.company = o.company
), ruled AS (
  SELECT *, declared_cancelled = 0 AND NOT some_cancelled AS nothing_cancelled,
         equal_cancelled OR (declared_cancelled = 0 AND NOT some_cancelled) AS cancel_ok
  FROM compared
), due AS (
  SELECT DISTINCT o.agency_name, o.emission, o.code, o.company, ext.description, ext.nature,
         ext.company AS event_company, ext.total
  FROM opened AS o JOIN ext ON ext.agency_name = o.agency_name AND ext.sale_date = o.sale_date
), hit AS (
  SELECT due.*, detail.text AS item_text, detail.value AS item_value,
         row_number() OVER (PARTITION BY due.agency_name, due.emission, due.code, due.company, due.description,
                            due.nature, due.event_company ORDER BY detail.text, detail.value NULLS FIRST) AS place
  FROM due LEFT JOIN detail ON detail.emission = due.emission AND detail.code = due.code
                           AND detail.company = due.company AND contains(detail.text, due.description)
), checked AS (
  SELECT * EXCLUDE (place),
         CASE WHEN item_text IS NULL THEN 'Transação de ' || description || ' não encontrada no Protheus.'
              WHEN item_value <> total THEN
                'Valor de ' || description || ' não bate com o valor encontrado no Protheus.' END AS message
  FROM hit WHERE place = 1
), told AS (
  SELECT agency_name, emission, code, company,
         string_agg(message, ';' ORDER BY description, nature NULLS FIRST, event_company, total) AS messages
  FROM checked WHERE message IS NOT NULL GROUP BY ALL
), reasoned AS (
  SELECT r.*, concat_ws(';', CASE WHEN NOT receipt_ok THEN 'Valor da receita não está batendo.' END,
           CASE WHEN NOT cancel_ok THEN 'Valores de bilhetes cancelados e devolvidos não batem.' END,
           told.messages) AS reasons,
         concat_ws(';', CASE WHEN has_pos THEN 'A ficha contém Vendas POS.' END,
           CASE WHEN has_requisitions THEN 'A ficha contém requisições.' END) AS flags
  FROM ruled AS r LEFT JOIN told ON told.agency_name = r.agency_name AND told.emission = r.emission
                                AND told.code = r.code AND told.company = r.company
), verdict AS (
  SELECT agency_name, code, number, 'valid' AS verdict, 'Ficha de remessa zerada.' AS message
  FROM ticket WHERE receipt = 0
  UNION ALL
  SELECT agency_name, code, number, CASE WHEN reasons = '' THEN 'valid' ELSE 'incongruent' END,
         CASE WHEN reasons <> '' THEN concat_ws(';', reasons, nullif(flags, ''))
              ELSE coalesce(nullif(concat_ws(';',
                CASE WHEN nothing_cancelled THEN 'Não há bilhetes cancelados e devolvidos.' END,
                nullif(flags, '')), ''), 'Nada a declarar.') END
  FROM reasoned
)
"""

LEDGER = r"""
WITH slip AS (
  SELECT c_name AS nome_agencia,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END
           AS cod_agencia_protheus,
         strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS num_ficha_protheus, o_orderstatus, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey
), target AS (
  SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus,
         CASE o_orderstatus WHEN 'F' THEN 'Nada a declarar.' ELSE 'A ficha contém Vendas POS.' END AS observacao,
         CASE WHEN o_orderpriority < '4' THEN '2002-01-01 08:00:00' ELSE '2002-03-01 08:00:00' END
           AS data_processamento
  FROM slip WHERE o_orderstatus <> 'O'
), source AS (
  SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'A ficha contém requisições.'
              WHEN o_orderstatus = 'F' THEN 'Nada a declarar.' ELSE 'A ficha contém Vendas POS.' END AS observacao,
         '2002-02-01 08:00:00' AS data_processamento, o_orderpriority AS prioridade
  FROM slip
), plain AS (
  SELECT t.nome_agencia, t.cod_agencia_protheus, t.num_ficha_protheus, t.observacao,
         CASE WHEN newer THEN '2002-02-01 08:00:00' ELSE t.data_processamento END AS data_processamento,
         CASE WHEN newer THEN 'updated' ELSE 'kept' END AS change
  FROM (SELECT *, data_processamento < '2002-02-01 08:00:00' AND EXISTS (
          SELECT 1 FROM source AS s
          WHERE s.nome_agencia = q.nome_agencia AND s.cod_agencia_protheus = q.cod_agencia_protheus
            AND s.num_ficha_protheus = q.num_ficha_protheus AND s.observacao = q.observacao) AS newer
        FROM target AS q) AS t
  UNION ALL
  SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus, observacao, data_processamento, 'inserted'
  FROM source AS s WHERE NOT EXISTS (
    SELECT 1 FROM target AS t
    WHERE s.nome_agencia = t.nome_agencia AND s.cod_agencia_protheus = t.cod_agencia_protheus
      AND s.num_ficha_protheus = t.num_ficha_protheus AND s.observacao = t.observacao)
), newest AS (
  SELECT * FROM source QUALIFY row_number() OVER (
    PARTITION BY cod_agencia_protheus, num_ficha_protheus
    ORDER BY data_processamento DESC, nome_agencia DESC NULLS LAST, observacao DESC NULLS LAST) = 1
), keyed AS (
  SELECT CASE WHEN newer THEN n.nome_agencia ELSE t.nome_agencia END AS nome_agencia,
         t.cod_agencia_protheus, t.num_ficha_protheus,
         CASE WHEN newer THEN n.observacao ELSE t.observacao END AS observacao,
         CASE WHEN newer THEN n.data_processamento ELSE t.data_processamento END AS data_processamento,
         CASE WHEN newer THEN 'updated' ELSE 'kept' END AS change
  FROM target AS t
  LEFT JOIN newest AS n ON n.cod_agencia_protheus = t.cod_agencia_protheus
                       AND n.num_ficha_protheus = t.num_ficha_protheus
  CROSS JOIN LATERAL (SELECT coalesce(t.data_processamento < n.data_processamento, false) AS newer) AS f
  UNION ALL
  SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus, observacao, data_processamento, 'inserted'
  FROM source AS s WHERE NOT EXISTS (
    SELECT 1 FROM target AS t WHERE s.cod_agencia_protheus = t.cod_agencia_protheus
      AND s.num_ficha_protheus = t.num_ficha_protheus)
), evolved AS (
  SELECT t.nome_agencia, t.cod_agencia_protheus, t.num_ficha_protheus, t.observacao,
         CASE WHEN newer THEN n.data_processamento ELSE t.data_processamento END AS data_processamento,
         CASE WHEN newer THEN n.prioridade END AS prioridade,
         CASE WHEN newer THEN 'updated' ELSE 'kept' END AS change
  FROM target AS t
  LEFT JOIN (SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus, observacao,
                    max(data_processamento) AS data_processamento, max(prioridade) AS prioridade
             FROM source GROUP BY ALL) AS n
    ON n.nome_agencia = t.nome_agencia AND n.cod_agencia_protheus = t.cod_agencia_protheus
   AND n.num_ficha_protheus = t.num_ficha_protheus AND n.observacao = t.observacao
  CROSS JOIN LATERAL (SELECT coalesce(t.data_processamento < n.data_processamento, false) AS newer) AS f
  UNION ALL
  SELECT nome_agencia, cod_agencia_protheus, num_ficha_protheus, observacao, data_processamento, prioridade,
         'inserted'
  FROM source AS s WHERE NOT EXISTS (
    SELECT 1 FROM target AS t
    WHERE s.nome_agencia = t.nome_agencia AND s.cod_agencia_protheus = t.cod_agencia_protheus
      AND s.num_ficha_protheus = t.num_ficha_protheus AND s.observacao = t.observacao)
)
"""

# Losses for the rejects: what turns NULL is a property of the rows themselves.
REJECTS = BASE + r"""
, torn AS (
  SELECT CASE WHEN a.c_mktsegment <> 'MACHINERY' THEN t.agency_name END AS agency_name, t.code, t.company, t.number,
         t.emission, t.sale_date, CASE WHEN t.expenses <= t.receipt OR t.receipt = 0 THEN t.receipt END AS receipt
  FROM ticket AS t JOIN agency AS a ON a.code = t.code
), items AS (
  SELECT emission, code, company, text, CASE WHEN text <> 'BILHETE DEVOLVIDO' AND NOT contains(text, 'STANDARD')
         THEN value END AS value
  FROM detail
), cause AS (
  SELECT t.*, CASE
    WHEN agency_name IS NULL THEN 'agency_name is null'
    WHEN receipt IS NULL THEN 'receipt is null'
    WHEN receipt = 0 THEN NULL
    WHEN EXISTS (SELECT 1 FROM items AS i WHERE i.emission = t.emission AND i.code = t.code
                 AND i.company = t.company AND i.text = 'BILHETE DEVOLVIDO')
      THEN 'first cancelled item has no value'
    WHEN EXISTS (SELECT 1 FROM ext WHERE ext.agency_name = t.agency_name AND ext.sale_date = t.sale_date
                 AND ext.description = 'PROMO')
      THEN 'extra event has no description'
    WHEN EXISTS (SELECT 1 FROM ext JOIN items AS i ON contains(i.text, ext.description)
                 WHERE ext.agency_name = t.agency_name AND ext.sale_date = t.sale_date
                 AND i.emission = t.emission AND i.code = t.code AND i.company = t.company AND i.value IS NULL)
      THEN 'first item of an extra event has no value' END AS cause
  FROM torn AS t
)
SELECT agency_name, code AS agency_code, company AS associated_company, number AS ticket_number, emission,
       CAST(receipt AS DOUBLE) AS receipt, cause
FROM cause WHERE cause IS NOT NULL
"""

TOTALS = """
SELECT agency_name, CAST(sale_date AS VARCHAR) AS sale_date, company AS associated_company,
       CAST(ticket_total AS DOUBLE) AS ticket_total, CAST(boarding_tax_total AS DOUBLE) AS boarding_tax_total,
       CAST(toll_tax_total AS DOUBLE) AS toll_tax_total, CAST(others_total AS DOUBLE) AS others_total,
       CAST(insurance_total AS DOUBLE) AS insurance_total, CAST(total AS DOUBLE) AS {name}
FROM tot WHERE {which}
"""

# Descriptions as patterns: the word in the middle may be any, so several events may share one.
PATTERNS = (
    BASE.replace(
        "o.company, ext.description, ext.nature",
        r"o.company, ext.description AS bill, regexp_replace(ext.description, ' \S+ ', ' .* ') AS description, ext.nature",
    )
    .replace("due.company, due.description,", "due.company, due.bill,")
    .replace("contains(detail.text, due.description)", "regexp_matches(detail.text, due.description)")
)

RESULT = """
SELECT agency_name AS nome_agencia, code AS cod_agencia_protheus, number AS num_ficha_protheus,
       {message} AS {column}{more}
FROM verdict WHERE verdict = '{verdict}'
"""

EXPORT_DAY = "19980315"
_STAMPED = ", '2002-01-01 08:00:00' AS data_processamento"


def _exported(column: str, verdict: str) -> str:
    text = RESULT.format(message="replace(message, ';', ' ')", column=column, more=_STAMPED, verdict=verdict)
    return BASE + text + f" AND TRY_CAST(number AS BIGINT) = {EXPORT_DAY}"


TEXTS = {
    "scan_tickets": BASE
    + """
SELECT company AS associated_company, agency_name, code AS agency_code, number AS ticket_number,
       CAST(receipt AS DOUBLE) AS receipt, CAST(expenses AS DOUBLE) AS expenses,
       CAST(receipt - expenses AS DOUBLE) AS net_value, emission, CAST(emission_date AS VARCHAR) AS emission_date
FROM ticket
""",
    "scan_sales": BASE
    + """
SELECT point AS puntoventa_id, type AS tipoventa_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS fechorventa,
       status AS indstatusboleto,
       CAST(price AS DOUBLE) AS preciopagado, CAST(boarding AS DOUBLE) AS importetaxaembarque,
       CAST(toll AS DOUBLE) AS importepedagio, CAST(others AS DOUBLE) AS importeoutros,
       CAST(insurance AS DOUBLE) AS importeseguro, active AS activo
FROM sale
""",
    "param_query": BASE
    + """
SELECT company AS associated_company, count(*) AS tickets, CAST(sum(receipt) AS DOUBLE) AS declared
FROM ticket WHERE emission BETWEEN '19960101' AND '19991231' AND receipt >= 100.00
GROUP BY company
""",
    "first_row": BASE
    + """
SELECT company AS associated_company, agency_name, code AS agency_code, number AS ticket_number,
       CAST(receipt AS DOUBLE) AS receipt, CAST(expenses AS DOUBLE) AS expenses,
       CAST(receipt - expenses AS DOUBLE) AS net_value, emission, CAST(emission_date AS VARCHAR) AS emission_date
FROM ticket ORDER BY ticket.receipt DESC, code, number LIMIT 1
""",
    "ticket_details": BASE
    + """
SELECT emission, company AS associated_company, agency_name, code AS agency_code, number AS ticket_number,
       CASE kind WHEN 1 THEN 'RECEITA' WHEN 2 THEN 'DESPESA' ELSE 'ERRO' END AS transaction_type,
       text AS transaction_description, CAST(value AS DOUBLE) AS transaction_value
FROM detail
""",
    "sales_totals": BASE + TOTALS.format(name="receipt_total", which="NOT cancelled"),
    "cancelled_totals": BASE + TOTALS.format(name="cancelled_total", which="cancelled"),
    "extra_events": BASE
    + """
SELECT agency_name, CAST(sale_date AS VARCHAR) AS sale_date, description || ' ' AS bill_description, description,
       nature, company AS associated_company, CAST(total AS DOUBLE) AS total
FROM ext ORDER BY description
""",
    "date_align": BASE
    + """
SELECT code AS agency_code, number AS ticket_number, emission, CAST(emission_date AS VARCHAR) AS emission_date,
       CAST(sale_date AS VARCHAR) AS sale_date, strftime(emission_date - 1, '%Y%m%d') AS closing_day,
       strftime(sale_date, '%d-%b-%y') AS sale_day_text,
       number = strftime(emission_date - 1, '%Y%m%d') AS exported
FROM ticket
""",
    "receipt_match": BASE
    + """
SELECT agency_name, code AS agency_code, company AS associated_company, number AS ticket_number, emission,
       CAST(receipt AS DOUBLE) AS receipt, receipt_ok
FROM ruled
""",
    "cancel_match": BASE
    + """
SELECT agency_name, code AS agency_code, company AS associated_company, number AS ticket_number, emission,
       CAST(declared_cancelled AS DOUBLE) AS declared_cancelled, nothing_cancelled, cancel_ok
FROM ruled
""",
    "first_item": BASE
    + """
SELECT emission, code AS agency_code, company AS associated_company, cancelled_text AS cancelled_description,
       CAST(cancelled_value AS DOUBLE) AS cancelled_value, returned_text AS returned_description,
       CAST(returned_value AS DOUBLE) AS returned_value
FROM firsts
""",
    "flag_items": BASE
    + """
SELECT emission, code AS agency_code, company AS associated_company, has_pos, has_requisitions FROM firsts
""",
    "event_match": BASE
    + """
SELECT agency_name, emission, code AS agency_code, company AS associated_company, description, nature,
       event_company, CAST(total AS DOUBLE) AS total, item_text AS found_description,
       CAST(item_value AS DOUBLE) AS found_value, message
FROM checked
""",
    "event_pattern": PATTERNS
    + """
SELECT agency_name, emission, code AS agency_code, company AS associated_company, description, nature,
       event_company, CAST(total AS DOUBLE) AS total, item_text AS found_description,
       CAST(item_value AS DOUBLE) AS found_value, message
FROM (SELECT * EXCLUDE (bill) FROM checked)
""",
    "reconcile_none": BASE
    + """
SELECT agency_name, code AS agency_code, company AS associated_company, number AS ticket_number, emission,
       CAST(receipt AS DOUBLE) AS receipt, 'none' AS verdict, 'none' AS message
FROM ticket WHERE emission = '19980316' AND emission <> '19980316'
""",
    "reconcile_empty": BASE
    + RESULT.format(message="message", column="observacao", more="", verdict="valid")
    + " AND message = 'Ficha de remessa zerada.'",
    "reconcile_reasons": BASE + RESULT.format(message="message", column="motivo_erro", more="", verdict="incongruent"),
    "reconcile_verdict": BASE
    + """
SELECT agency_name AS nome_agencia, code AS cod_agencia_protheus, number AS num_ficha_protheus, verdict, message
FROM verdict
""",
    "reconcile_rejects": REJECTS,
    "export_valid": _exported("observacao", "valid"),
    "export_incongruent": _exported("motivo_erro", "incongruent"),
    "upsert_create": LEDGER + "SELECT *, 'inserted' AS change FROM source",
    "upsert_update": LEDGER + "SELECT * FROM plain WHERE change <> 'inserted'",
    "upsert_insert": LEDGER + "SELECT * FROM plain",
    "upsert_keyed": LEDGER + "SELECT * FROM keyed",
    "upsert_evolve": LEDGER + "SELECT * FROM evolved",
    "upsert_empty": LEDGER + "SELECT * FROM target",
    "upsert_exclude": LEDGER
    + """
, best AS (
  SELECT cod_agencia_protheus, num_ficha_protheus, max(observacao) AS observacao,
         max(data_processamento) AS data_processamento
  FROM source GROUP BY ALL
)
SELECT t.nome_agencia, t.cod_agencia_protheus, t.num_ficha_protheus,
       CASE WHEN newer THEN n.observacao ELSE t.observacao END AS observacao,
       CASE WHEN newer THEN n.data_processamento ELSE t.data_processamento END AS data_processamento,
       CASE WHEN newer THEN 'updated' ELSE 'kept' END AS change
FROM target AS t
LEFT JOIN best AS n ON n.cod_agencia_protheus = t.cod_agencia_protheus
                   AND n.num_ficha_protheus = t.num_ficha_protheus
CROSS JOIN LATERAL (SELECT coalesce(t.data_processamento < n.data_processamento, false) AS newer) AS f
UNION ALL
SELECT NULL, cod_agencia_protheus, num_ficha_protheus, observacao, data_processamento, 'inserted'
FROM source AS s WHERE NOT EXISTS (
  SELECT 1 FROM target AS t WHERE s.cod_agencia_protheus = t.cod_agencia_protheus
    AND s.num_ficha_protheus = t.num_ficha_protheus)
""",
    "upsert_counts": LEDGER
    + """
SELECT matched_on, CAST(count_if(change = 'updated') AS BIGINT) AS updated,
       CAST(count_if(change = 'inserted') AS BIGINT) AS inserted,
       CAST(count_if(change <> 'kept') AS BIGINT) AS affected
FROM (SELECT 'all columns' AS matched_on, change FROM plain
      UNION ALL SELECT 'agency and number', change FROM keyed)
GROUP BY matched_on
""",
}
