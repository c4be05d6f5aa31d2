"""SQL pieces shared by the comparison queries.  They restate the bindings for
DuckDB and are written apart from the Spark plans they check."""

# Every invoice delivered, resends included, then the conformed table.
INVOICES = """
delivered AS (
  SELECT c_mktsegment AS seg, o_orderkey, c_custkey, c_name, c_nationkey, o_orderstatus, o_orderpriority,
         CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, 0 AS resend
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT c_mktsegment, o_orderkey, c_custkey, c_name, c_nationkey, o_orderstatus, o_orderpriority,
         CAST(o_orderdate AS DATE), CAST(o_totalprice AS DECIMAL(18,2)) + 10, 1
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE c_mktsegment = 'FURNITURE' AND o_orderpriority = '1-URGENT'
),
latest AS (
  SELECT * FROM delivered
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY resend DESC) = 1
),
tagged AS (
  SELECT *, CASE seg WHEN 'BUILDING' THEN 'ORACLE' WHEN 'FURNITURE' THEN 'BAAN' WHEN 'HOUSEHOLD' THEN 'WORKDAY' ELSE 'SAP' END AS src,
         CASE seg WHEN 'BUILDING' THEN 'ORA' WHEN 'FURNITURE' THEN 'BAN' WHEN 'HOUSEHOLD' THEN 'WD' ELSE 'SAP' END AS pre,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 30 ELSE 60 END AS days
  FROM latest
),
inv AS (
  SELECT pre || '-' || o_orderkey || CASE WHEN resend = 1 THEN '-R' ELSE '' END AS invoice_id,
         pre || '-INV-' || o_orderkey AS invoice_number,
         'V-' || c_custkey AS vendor_id, c_name AS vendor_name, d AS invoice_date,
         d + days AS due_date, CAST(amt AS DECIMAL(18,2)) AS invoice_amount,
         CASE WHEN c_nationkey < 9 THEN CASE src WHEN 'BAAN' THEN 'EUR' ELSE 'USD' END
              WHEN c_nationkey < 17 THEN 'EUR' ELSE 'GBP' END AS currency_code,
         CASE src WHEN 'SAP' THEN 'NET' WHEN 'WORKDAY' THEN 'Net ' ELSE 'N' END || days AS payment_terms,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'PO-' || o_orderkey END AS po_number,
         seg || ' ' || o_orderpriority AS line_description,
         pre || '-GL-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS gl_account,
         pre || '-CC-' || o_orderstatus AS cost_center,
         CASE o_orderstatus WHEN 'P' THEN 'PENDING' ELSE 'APPROVED' END AS approval_status,
         CAST(d AS TIMESTAMP) + INTERVAL 1 HOUR * resend AS created_at, src AS source_system
  FROM tagged
)"""


def with_invoices(body: str) -> str:
    return f"WITH {INVOICES.strip()}\n{body.strip()}"
