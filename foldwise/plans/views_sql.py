"""SQL text of the derived views, for the DuckDB oracle.

These mirror :mod:`foldwise.sources.tables` and run unchanged on DuckDB over the pre-registered
base tables. Oracle statements reference them as CTEs through :func:`with_views`.
"""

from __future__ import annotations

VIEW_SQL = {
    "p": """
SELECT c.c_custkey AS id,
  CASE WHEN c.c_nationkey % 4 = 0 THEN 2 ELSE 1 END AS target_raw,
  CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_mktsegment END AS cat_a,
  CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE r.r_name END AS cat_b,
  CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 97 = 0 THEN CAST(-187 AS DOUBLE)
       ELSE 140 + c.c_acctbal / 150 END AS num_a,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL WHEN c.c_custkey % 101 = 0 THEN CAST(-1000 AS DOUBLE)
       ELSE 45 + c.c_acctbal / 200 + c.c_nationkey END AS num_b,
  CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE CAST(70 + (c.c_custkey * 37) % 80 AS DOUBLE) END AS num_c,
  CASE WHEN c.c_custkey % 12 = 0 THEN NULL WHEN c.c_custkey % 103 = 0 THEN CAST(-1000 AS DOUBLE)
       ELSE CAST((c.c_custkey * 7919) % 3000 AS DOUBLE) END AS long_tail,
  CASE WHEN c.c_custkey % 8 = 0 THEN NULL ELSE CAST(1 + c.c_custkey % 5 AS DOUBLE) END AS ord_a,
  CASE WHEN c.c_custkey % 13 = 0 THEN '#NUM!' ELSE CAST(c.c_custkey % 200 AS VARCHAR) END AS raw_num,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE d.text END AS note
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN documents d ON d.doc_id = c.c_custkey""",
    "r": """
SELECT o_orderkey AS run_id,
  concat('exp_', lpad(CAST(o_orderkey AS VARCHAR), 8, '0'), '_',
         CASE o_orderkey % 4 WHEN 0 THEN 'RF' WHEN 1 THEN 'GBT' WHEN 2 THEN 'SVM' ELSE 'DT' END,
         '_method', CAST(o_custkey % 4 AS VARCHAR)) AS run_name,
  concat('cfg_', CAST(o_custkey % 40 AS VARCHAR)) AS config_file,
  o_orderdate AS ts,
  CASE WHEN o_orderkey % 10 = 0 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL
       ELSE 0.7 + CAST((o_orderkey * 7919) % 2500 AS DOUBLE) / 10000 END AS mean_f1,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL
       ELSE CAST((o_orderkey * 31) % 400 AS DOUBLE) / 10000 END AS std_f1
FROM orders""",
    "m": """
SELECT o_custkey % 12 AS candidate, o_orderkey % 5 AS fold,
  CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'validation' END AS split,
  'f1' AS metric, 0.6 + avg(o_totalprice) / 1000000 AS value
FROM orders
GROUP BY o_custkey % 12, o_orderkey % 5, CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'validation' END""",
    "i": """
SELECT l_orderkey % 5 AS fold,
  concat(CASE l_partkey % 4 WHEN 0 THEN 'num' WHEN 1 THEN 'log' WHEN 2 THEN 'cat' ELSE 'ord' END,
         '__f', CAST(l_partkey % 20 AS VARCHAR)) AS feature,
  sum(l_quantity) AS importance
FROM lineitem
GROUP BY 1, 2""",
    "t": """
SELECT d.doc_id AS id, d.text, d.lang, l.quality AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "rp": """
SELECT d.doc_id AS id, l.quality AS label,
  CASE WHEN d.n_chars % 10 < 8 THEN 1 ELSE 0 END AS pred,
  CAST(d.n_chars % 100 AS DOUBLE) / 100 AS score
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named views as CTEs (in the order given)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
