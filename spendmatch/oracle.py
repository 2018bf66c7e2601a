"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is written as plain SQL over the driver's pre-registered views
(``supplier``, ``lineitem``, ...).  Named CTE fragments are kept in one
registry with their dependencies; :func:`query` assembles ``WITH`` clauses
in dependency order.  The SQL follows the source system's semantics in
SQL's own idiom (``NOT EXISTS``, window functions) and shares no code with the
Spark implementation.
"""

from __future__ import annotations

# --------------------------------------------------------------- expressions


def report(cols: dict[str, str], source: str, top: str | None = None, limit: int | None = None, group: bool = False) -> str:
    """A report over ``source``: named expressions, largest ``top`` first, ties by the other columns as listed.

    ``group`` groups by the plain columns; expressions with a call of SUM or COUNT are totals.
    """
    total = {n for n, e in cols.items() if e.startswith(("SUM(", "COUNT("))}
    sql = f"SELECT {', '.join(f'{e} AS {chr(34)}{n}{chr(34)}' for n, e in cols.items())} FROM {source}"
    if group:
        sql += f" GROUP BY {', '.join(e for n, e in cols.items() if n not in total)}"
    if limit:
        rest = [f'"{n}" ASC NULLS LAST' for n in cols if n != top and n not in total]
        sql += f" ORDER BY {', '.join(([f'{chr(34)}{top}{chr(34)} DESC NULLS LAST'] if top else []) + rest)} LIMIT {limit}"
    return sql


def name_form(n: str, k: str) -> str:
    return (f"CASE ({k}) WHEN 0 THEN {n} || ', LLC' WHEN 1 THEN {n} || ' Inc.' "
            f"WHEN 2 THEN UPPER({n}) ELSE '  ' || {n} || ' ' END")


def cert_of(k: str) -> str:
    return (f"CASE ({k}) WHEN 0 THEN 'MBE' WHEN 1 THEN 'MWBE' WHEN 2 THEN 'WBE' WHEN 3 THEN 'CBE' "
            f"WHEN 4 THEN 'SEDBE' WHEN 5 THEN 'VOB' WHEN 6 THEN 'DBE' END")


def canon_a(x: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(upper(trim({x})), '[^A-Z0-9 ]', '', 'g'), "
            f"'\\s+', ' ', 'g'), '\\b(LLC|INC|LTD|CO|CORP|COMPANY)\\b', '', 'g')")


def canon_b(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(upper(trim({x})), "
            f"'\\s+(LLC|INC\\.?|LTD\\.?|CO\\.?|CORP\\.?|COMPANY|INCORPORATED|CORPORATION)(\\s|$)', '', 'gi'), "
            f"'[^A-Z0-9 ]', '', 'g'), '\\s+', ' ', 'g'))")


def nb(x: str) -> str:
    """NULLIF(TRIM(x), '')"""
    return f"NULLIF(TRIM(CAST({x} AS VARCHAR)), '')"


def qual(x: str) -> str:
    return f"(UPPER(TRIM({x})) IN ('MBE', 'WBE', 'MWBE', 'SEDBE', 'CBE'))"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


def _rank(x: str) -> str:
    return (f"CASE {x} WHEN 'MBE' THEN 1 WHEN 'MWBE' THEN 2 WHEN 'WBE' THEN 3 WHEN 'CBE' THEN 4 "
            f"WHEN 'SEDBE' THEN 5 WHEN 'VOB' THEN 6 ELSE 999 END")


# ------------------------------------------------------------------ registry
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


def query(final_sql: str, deps: list[str]) -> str:
    """Assemble ``WITH`` + the needed fragments (dependency order) + final SELECT."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final_sql
    # each step once: nested marts would otherwise be inlined again and again
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


cte("sup", [], """
  SELECT s_suppkey, s_name,
    CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE CAST(s_suppkey + 5000 AS VARCHAR) END AS vnum,
    CASE WHEN s_suppkey % 5 = 0 THEN ' ' WHEN s_suppkey % 11 = 0 THEN NULL
         ELSE CAST(s_suppkey + 100000000 AS VARCHAR) END AS vtax
  FROM supplier""")

cte("vendors", ["sup"], f"""
  SELECT 'U' || s_suppkey AS uniqueid, vnum AS b2gnow_vendor_number, vtax AS tax_id,
         {name_form('s_name', 's_suppkey % 4')} AS business_name, {cert_of('s_suppkey % 8')} AS certification_type,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Expired' ELSE 'Active' END AS certification_status
  FROM sup
  UNION ALL
  SELECT 'U' || s_suppkey, vnum, vtax, {name_form('s_name', 's_suppkey % 4')}, {cert_of('(s_suppkey + 3) % 8')},
         'Active' FROM sup WHERE s_suppkey % 7 = 0
  UNION ALL
  SELECT 'U' || s_suppkey, vnum, vtax, 'Other ' || s_name, 'WBE', 'Active' FROM sup WHERE s_suppkey % 13 = 0""")

cte("agency_spend", ["sup"], f"""
  SELECT CAST(n_nationkey AS BIGINT) * 1000000 + s_suppkey AS row_id,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Agency' ELSE 'Higher Ed' END AS source,
    CASE WHEN n_nationkey % 12 = 11 THEN NULL ELSE CAST(n_nationkey AS VARCHAR) END AS agency_number,
    n_name AS agency_name,
    {name_form('s_name', '(s_suppkey + n_nationkey) % 4')} AS business_name,
    CASE WHEN (s_suppkey + n_nationkey) % 3 = 0 THEN ''
         WHEN (s_suppkey + n_nationkey) % 7 = 1 THEN CAST(s_suppkey + 700000000 AS VARCHAR) ELSE vtax END AS tax_id,
    CASE WHEN s_suppkey % 29 = 0 THEN NULL ELSE amt END AS total_amount
  FROM (SELECT c_nationkey, l_suppkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY c_nationkey, l_suppkey) sp
  JOIN nation ON sp.c_nationkey = n_nationkey JOIN sup ON sp.l_suppkey = s_suppkey""")

cte("contract_lines", ["sup"], f"""
  SELECT
    CASE WHEN l_partkey % 4 = 0 THEN ' ' ELSE ls.vnum END AS b2gnow_id,
    CASE WHEN l_orderkey % 31 = 7 THEN 'Harbor Works ' || CAST(l_orderkey % 5 AS VARCHAR) ELSE ps.s_name END AS prime_vendor,
    n_name AS contract_holder,
    CASE WHEN l_linenumber = 1 THEN ps.s_name ELSE {name_form('ls.s_name', 'l_linenumber % 3')} END AS business_name,
    CASE WHEN l_linenumber = 1 THEN ' Prime ' WHEN l_linenumber = 2 THEN 'sub' ELSE 'Subcontractor' END
      AS vendor_type,
    CASE WHEN l_linenumber = 1 THEN 'PRIME' ELSE 'SUB' END AS payment_type,
    CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount_paid,
    CAST(l_shipdate AS TIMESTAMP) AS audit_period,
    CASE WHEN l_partkey % 3 = 0 THEN '' ELSE ls.vtax END AS taxidnumber,
    l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN sup ls ON l_suppkey = ls.s_suppkey
  LEFT JOIN sup ps ON ps.s_suppkey = l_orderkey % (SELECT count(*) FROM supplier)""")

cte("contracts", ["contract_lines"], """
  SELECT * EXCLUDE (l_orderkey) FROM contract_lines
  UNION ALL
  SELECT * EXCLUDE (l_orderkey) FROM contract_lines WHERE l_orderkey % 97 = 0""")

_VD_ORDER = ("CASE WHEN certification_status = 'Active' THEN 0 ELSE 1 END, "
             f"{_rank('certification_type')}, certification_type NULLS LAST")

cte("vd_tn", ["vendors"], f"""
  SELECT tax_id, canon_name, certification_type FROM (
    SELECT {nb('tax_id')} AS tax_id, {canon_a('business_name')} AS canon_name, certification_type,
           certification_status,
           row_number() OVER (PARTITION BY COALESCE({nb('tax_id')}, 'NO_TAX'), {canon_a('business_name')}
                              ORDER BY {_VD_ORDER}) AS rn
    FROM vendors) x
  WHERE rn = 1 AND certification_status = 'Active'""")

cte("vd_tbn", ["vendors"], f"""
  SELECT tax_id, b2g_id, canon_name, certification_type FROM (
    SELECT {nb('tax_id')} AS tax_id, {nb('b2gnow_vendor_number')} AS b2g_id,
           {canon_a('business_name')} AS canon_name, certification_type, certification_status,
           row_number() OVER (PARTITION BY COALESCE({nb('tax_id')}, 'NO_TAX'),
                                           COALESCE({nb('b2gnow_vendor_number')}, 'NO_B2G'),
                                           {canon_a('business_name')}
                              ORDER BY {_VD_ORDER}) AS rn
    FROM vendors) x
  WHERE rn = 1 AND certification_status = 'Active'""")

# the agency's own tax id and the directory's, where a match shows that they differ
cte("two_tax_ids", ["agency_cert"], f"""
  SELECT *, {nb('tax_id')} AS own_id, {nb('matched_tax_id')} AS directory_id
  FROM agency_cert WHERE match_method <> 'unmatched' AND {nb('tax_id')} <> {nb('matched_tax_id')}""")

# ---- M6 agency_cert: cascade by input row (tax id, else name)
cte("ah", ["agency_spend"], f"""
  SELECT *, {nb('tax_id')} AS tax_norm, {canon_a('business_name')} AS canon_name FROM agency_spend""")

cte("agency_cert", ["ah", "vd_tn"], f"""
  SELECT h.source, h.agency_number, h.agency_name, h.business_name, h.tax_id, {money('h.total_amount')} AS total_amount,
         v.certification_type, v.tax_id AS matched_tax_id, 'tax_id' AS match_method
  FROM ah h JOIN vd_tn v ON v.tax_id = h.tax_norm
  UNION ALL
  SELECT h.source, h.agency_number, h.agency_name, h.business_name, h.tax_id, {money('h.total_amount')},
         v.certification_type, v.tax_id, CASE WHEN v.canon_name IS NULL THEN 'unmatched' ELSE 'name' END
  FROM ah h LEFT JOIN vd_tn v ON v.canon_name = h.canon_name
  WHERE NOT EXISTS (SELECT 1 FROM vd_tn t WHERE t.tax_id = h.tax_norm)""")



# ---- M1 contract_cert (literal: natural-key anti joins and attach-back, T7)
cte("cn", ["contracts"], f"""
  SELECT {nb('b2gnow_id')} AS b2g_id, prime_vendor, contract_holder, business_name,
         UPPER(TRIM(vendor_type)) AS vendor_type, amount_paid, audit_period,
         {nb('taxidnumber')} AS taxidnumber, {canon_a('business_name')} AS canon_name
  FROM contracts""")

_CC_COLS = "c.*, v.certification_type, v.tax_id AS matched_tax_id, v.b2g_id AS matched_b2g_id"
_K4 = ("{a}.business_name = {b}.business_name AND {a}.contract_holder = {b}.contract_holder "
       "AND {a}.amount_paid = {b}.amount_paid AND {a}.audit_period = {b}.audit_period")

cte("cc_tax", ["cn", "vd_tbn"], f"""
  SELECT {_CC_COLS}, 'tax_id' AS match_method_cert FROM cn c JOIN vd_tbn v ON v.tax_id = c.taxidnumber""")
cte("cc_b2g", ["cn", "vd_tbn", "cc_tax"], f"""
  SELECT {_CC_COLS}, 'b2g_id' AS match_method_cert FROM cn c JOIN vd_tbn v ON v.b2g_id = c.b2g_id
  WHERE NOT EXISTS (SELECT 1 FROM cc_tax t WHERE t.b2g_id = c.b2g_id AND {_K4.format(a='t', b='c')})""")
cte("cc_name", ["cn", "vd_tbn", "cc_tax", "cc_b2g"], f"""
  SELECT {_CC_COLS}, 'name' AS match_method_cert FROM cn c JOIN vd_tbn v ON v.canon_name = c.canon_name
  WHERE NOT EXISTS (SELECT 1 FROM cc_tax t WHERE {_K4.format(a='t', b='c')})
    AND NOT EXISTS (SELECT 1 FROM cc_b2g b WHERE {_K4.format(a='b', b='c')})""")
cte("contract_cert", ["cn", "cc_tax", "cc_b2g", "cc_name"], f"""
  SELECT c.b2g_id, c.prime_vendor, c.contract_holder, c.business_name, c.vendor_type,
         {money('c.amount_paid')} AS amount_paid, c.audit_period, c.taxidnumber,
         m.certification_type, m.matched_tax_id, m.matched_b2g_id,
         COALESCE(m.match_method_cert, 'unmatched') AS match_method_cert
  FROM cn c LEFT JOIN (SELECT * FROM cc_tax UNION ALL SELECT * FROM cc_b2g UNION ALL SELECT * FROM cc_name) m
    ON {_K4.format(a='m', b='c')}""")

# ---- M1 row-id mode: per-row cascade
_CC_OUT = ("c.b2g_id, c.prime_vendor, c.contract_holder, c.business_name, c.vendor_type, "
           f"{money('c.amount_paid')} AS amount_paid, c.audit_period, c.taxidnumber, v.certification_type, "
           "v.tax_id AS matched_tax_id, v.b2g_id AS matched_b2g_id")
cte("contract_cert_rowid", ["cn", "vd_tbn"], f"""
  SELECT {_CC_OUT}, 'tax_id' AS match_method_cert FROM cn c JOIN vd_tbn v ON v.tax_id = c.taxidnumber
  UNION ALL
  SELECT {_CC_OUT}, 'b2g_id' FROM cn c JOIN vd_tbn v ON v.b2g_id = c.b2g_id
  WHERE NOT EXISTS (SELECT 1 FROM vd_tbn t WHERE t.tax_id = c.taxidnumber)
  UNION ALL
  SELECT {_CC_OUT}, CASE WHEN v.canon_name IS NULL THEN 'unmatched' ELSE 'name' END
  FROM cn c LEFT JOIN vd_tbn v ON v.canon_name = c.canon_name
  WHERE NOT EXISTS (SELECT 1 FROM vd_tbn t WHERE t.tax_id = c.taxidnumber)
    AND NOT EXISTS (SELECT 1 FROM vd_tbn t WHERE t.b2g_id = c.b2g_id)""")

# ---- M2 / M3 / M4 / M5
cte("contract_totals1", ["contract_cert"], f"""
  SELECT contract_holder AS agency_name, UPPER(TRIM(vendor_type)) AS vendor_type, prime_vendor, business_name,
         {nb('taxidnumber')} AS tax_id, {nb('b2g_id')} AS b2g_id, certification_type,
         CAST(matched_tax_id AS VARCHAR) AS matched_tax_id, match_method_cert,
         {money('SUM(COALESCE(amount_paid, 0))')} AS total_amount
  FROM contract_cert WHERE contract_holder IS NOT NULL AND business_name IS NOT NULL
  GROUP BY ALL""")
cte("contract_totals2", ["contract_cert"], f"""
  SELECT b2g_id, prime_vendor, contract_holder AS agency_name, business_name,
         UPPER(TRIM(vendor_type)) AS vendor_type, {nb('taxidnumber')} AS tax_id, certification_type,
         CAST(matched_tax_id AS VARCHAR) AS matched_tax_id, CAST(matched_b2g_id AS VARCHAR) AS matched_b2g_id,
         match_method_cert, MAX(audit_period) AS audit_period,
         {money('SUM(COALESCE(amount_paid, 0))')} AS total_amount
  FROM contract_cert WHERE contract_holder IS NOT NULL AND business_name IS NOT NULL
  GROUP BY b2g_id, prime_vendor, contract_holder, business_name, UPPER(TRIM(vendor_type)), {nb('taxidnumber')},
           certification_type, CAST(matched_tax_id AS VARCHAR), CAST(matched_b2g_id AS VARCHAR), match_method_cert""")
cte("contract_subs_spend", ["contract_totals2"], f"""
  SELECT *, {money(f"CASE WHEN {qual('certification_type')} THEN total_amount ELSE 0 END")} AS certified_spend
  FROM contract_totals2 WHERE UPPER(TRIM(vendor_type)) IN ('SUBCONTRACTOR', 'SUB')""")
cte("contract_prime_summary", ["contract_subs_spend"], f"""
  SELECT prime_vendor, agency_name, {money('SUM(total_amount)')} AS total_subs_amount,
         {money('SUM(certified_spend)')} AS certified_subs_spend,
         {money('SUM(total_amount) - SUM(certified_spend)')} AS uncertified_subs_spend,
         COUNT(*) AS sub_count
  FROM contract_subs_spend GROUP BY prime_vendor, agency_name""")

# ---- M8 flags
cte("cflag_src", ["contracts"], f"""
  SELECT {canon_a('business_name')} AS cname, {nb('taxidnumber')} AS ctax,
         UPPER(TRIM(vendor_type)) AS vt, UPPER(TRIM(payment_type)) AS pt
  FROM contracts WHERE business_name IS NOT NULL""")
_FP = ("COUNT(*) FILTER (WHERE vt IN ('PRIME', 'PRIME CONTRACTOR', 'PRIME VENDOR', 'CONTRACTOR') "
       "OR pt = 'PRIME') > 0")
_FS = "COUNT(*) FILTER (WHERE vt IN ('SUBCONTRACTOR', 'SUB') OR pt IN ('SUBCONTRACTOR', 'SUB')) > 0"
cte("flag_name", ["cflag_src"], f"SELECT cname, {_FP} AS fp, {_FS} AS fs FROM cflag_src GROUP BY cname")
cte("flag_tax", ["cflag_src"], f"""
  SELECT ctax, {_FP} AS fp, {_FS} AS fs FROM cflag_src WHERE ctax IS NOT NULL GROUP BY ctax""")
cte("agency_cert_flags", ["agency_cert", "flag_name", "flag_tax"], f"""
  SELECT a.*, TRUE AS in_contracts_business_name, t.fp AS has_vendor_type_prime, t.fs AS has_vendor_type_sub,
         t.ctax AS matched_taxid_to_contracts, 'tax_id' AS match_method_contract
  FROM agency_cert a JOIN flag_tax t ON t.ctax = {nb('a.tax_id')}
  UNION ALL
  SELECT a.*, n.cname IS NOT NULL, COALESCE(n.fp, FALSE), COALESCE(n.fs, FALSE), NULL,
         CASE WHEN n.cname IS NULL THEN 'unmatched' ELSE 'name' END
  FROM agency_cert a LEFT JOIN flag_name n ON n.cname = {canon_a('a.business_name')}
  WHERE NOT EXISTS (SELECT 1 FROM flag_tax t WHERE t.ctax = {nb('a.tax_id')})""")

# ---- M9 prime totals
cte("prime_totals", ["agency_cert_flags"], f"""
  SELECT source, agency_number, agency_name, business_name AS prime_vendor, tax_id,
         MAX(certification_type) AS prime_certification_type, MAX(matched_tax_id) AS matched_tax_id,
         MAX(match_method) AS match_method,
         bool_or(in_contracts_business_name) AS in_contracts_business_name,
         bool_or(has_vendor_type_prime) AS has_vendor_type_prime,
         bool_or(has_vendor_type_sub) AS has_vendor_type_sub,
         NULLIF(MAX(COALESCE(matched_taxid_to_contracts, '')), '') AS matched_taxid_to_contracts,
         NULLIF(MAX(COALESCE(match_method_contract, '')), '') AS match_method_contract,
         {money('SUM(COALESCE(total_amount, 0))')} AS prime_total_amount
  FROM agency_cert_flags GROUP BY source, agency_number, agency_name, business_name, tax_id""")

# ---- M10 certified spend
cte("subs_by_agency_prime", ["contract_cert"], f"""
  SELECT {canon_a('contract_holder')} AS ca, {canon_a('prime_vendor')} AS cp,
         SUM(CASE WHEN vendor_type IN ('SUBCONTRACTOR', 'SUB') AND certification_type IS NOT NULL
                  THEN amount_paid ELSE 0 END) AS sc,
         SUM(CASE WHEN vendor_type IN ('SUBCONTRACTOR', 'SUB') AND certification_type IS NULL
                  THEN amount_paid ELSE 0 END) AS su
  FROM contract_cert
  WHERE business_name IS NOT NULL AND prime_vendor IS NOT NULL AND contract_holder IS NOT NULL
  GROUP BY 1, 2""")
cte("certified_spend", ["agency_cert_flags", "subs_by_agency_prime"], f"""
  SELECT f.*, {money('COALESCE(s.sc, 0)')} AS subs_certified_amount,
         {money('COALESCE(s.su, 0)')} AS subs_uncertified_amount,
         {money("CASE WHEN f.certification_type IS NOT NULL THEN GREATEST(f.total_amount - COALESCE(s.su, 0), 0) ELSE COALESCE(s.sc, 0) END")} AS certified_spend
  FROM agency_cert_flags f LEFT JOIN subs_by_agency_prime s
    ON s.ca = {canon_a('f.agency_name')} AND s.cp = {canon_a('f.business_name')}""")

# ---- M11-M14 prime with subs
cte("pc", ["prime_totals"], f"""
  SELECT source, agency_number, agency_name, prime_vendor, tax_id AS prime_tax_id, prime_certification_type,
         matched_tax_id AS prime_matched_tax_id, match_method AS prime_match_method, prime_total_amount,
         {canon_b('prime_vendor')} AS cpv, {canon_b('agency_name')} AS can
  FROM prime_totals""")
cte("cs", ["contract_totals2"], f"""
  SELECT tax_id AS s_tax, {canon_b('prime_vendor')} AS s_cpv, {canon_b('agency_name')} AS s_can,
         b2g_id AS sub_b2g_id, business_name AS sub_business_name, certification_type AS sub_certification_type,
         matched_tax_id AS sub_matched_tax_id, matched_b2g_id AS sub_matched_b2g_id,
         match_method_cert AS sub_match_method, audit_period AS sub_audit_period, total_amount AS sub_amount
  FROM contract_totals2 WHERE UPPER(TRIM(vendor_type)) IN ('SUBCONTRACTOR', 'SUB')""")
_P4 = "{a}.source = {b}.source AND {a}.agency_number = {b}.agency_number AND {a}.agency_name = {b}.agency_name AND {a}.prime_vendor = {b}.prime_vendor"
_PRIME_HEAD = ("p.source, p.agency_number, p.agency_name, p.prime_vendor")
_PRIME_INFO = "p.prime_tax_id, p.prime_certification_type, p.prime_matched_tax_id, p.prime_match_method"
_NULL_SUBS = ("NULL::VARCHAR AS sub_b2g_id, NULL::VARCHAR AS sub_tax_id, NULL::VARCHAR AS sub_certification_type, "
              "NULL::VARCHAR AS sub_matched_tax_id, NULL::VARCHAR AS sub_matched_b2g_id, "
              "NULL::VARCHAR AS sub_match_method, NULL::TIMESTAMP AS sub_audit_period, "
              "NULL::DECIMAL(38,2) AS sub_amount")
_SUBS = ("s.sub_b2g_id, s.s_tax AS sub_tax_id, s.sub_certification_type, s.sub_matched_tax_id, "
         f"s.sub_matched_b2g_id, s.sub_match_method, s.sub_audit_period, {money('s.sub_amount')} AS sub_amount")


def prime_with_subs_sql(mode: str) -> str:
    prime_cols = (f"{_PRIME_HEAD}, p.prime_vendor AS business_name, 'PRIME' AS vendor_type, {_PRIME_INFO}, "
                  f"{money('p.prime_total_amount')} AS prime_total_amount")
    sub_head = f"{_PRIME_HEAD}, s.sub_business_name AS business_name, 'SUBCONTRACTOR' AS vendor_type, {_PRIME_INFO}"
    if mode == "rows":
        return query(f"""
SELECT {prime_cols}, {_NULL_SUBS} FROM pc p
UNION ALL
SELECT {sub_head}, NULL::DECIMAL(38,2) AS prime_total_amount, {_SUBS}
FROM pc p JOIN cs s ON p.cpv = s.s_cpv AND p.can = s.s_can""", ["pc", "cs"])
    if mode in ("any_cert", "qualifying"):
        if mode == "any_cert":
            c_cond, u_cond = "s.sub_certification_type IS NOT NULL", "s.sub_certification_type IS NULL"
            p_cond = "p.prime_certification_type IS NOT NULL"
        else:
            c_cond = qual("s.sub_certification_type")
            u_cond = f"s.sub_certification_type IS NULL OR NOT {qual('s.sub_certification_type')}"
            p_cond = qual("p.prime_certification_type")
        return query(f"""
, st AS (
  SELECT {_PRIME_HEAD},
         SUM(CASE WHEN {c_cond} THEN COALESCE(s.sub_amount, 0) ELSE 0 END) AS ct,
         SUM(CASE WHEN {u_cond} THEN COALESCE(s.sub_amount, 0) ELSE 0 END) AS ut
  FROM pc p LEFT JOIN cs s ON p.cpv = s.s_cpv AND p.can = s.s_can
  GROUP BY p.source, p.agency_number, p.agency_name, p.prime_vendor)
SELECT {prime_cols},
       {money(f"CASE WHEN {p_cond} THEN CASE WHEN st.ut > 0 THEN p.prime_total_amount - st.ut ELSE p.prime_total_amount END ELSE COALESCE(st.ct, 0) END")} AS certified_spend,
       {_NULL_SUBS}
FROM pc p LEFT JOIN st ON {_P4.format(a='st', b='p')}
UNION ALL
SELECT {sub_head}, NULL::DECIMAL(38,2), NULL::DECIMAL(38,2), {_SUBS}
FROM pc p JOIN cs s ON p.cpv = s.s_cpv AND p.can = s.s_can""", ["pc", "cs"]).replace("\n\n, st AS", ",\nst AS").replace(")\n, st AS", "),\nst AS")
    # tax_then_name
    return query(f"""
, mt AS (SELECT p.*, s.*, 'tax_id' AS match_method FROM pc p JOIN cs s
          ON CAST(p.prime_matched_tax_id AS VARCHAR) = CAST(s.s_tax AS VARCHAR) AND p.can = s.s_can),
mn AS (SELECT p.*, s.*, 'name' AS match_method FROM pc p JOIN cs s ON p.cpv = s.s_cpv AND p.can = s.s_can
       WHERE NOT EXISTS (SELECT 1 FROM mt WHERE {_P4.format(a='mt', b='p')})),
am AS (SELECT * FROM mt UNION ALL SELECT * FROM mn),
st AS (SELECT source, agency_number, agency_name, prime_vendor,
         SUM(CASE WHEN {qual('sub_certification_type')} THEN COALESCE(sub_amount, 0) ELSE 0 END) AS ct,
         SUM(CASE WHEN sub_certification_type IS NULL OR NOT {qual('sub_certification_type')}
                  THEN COALESCE(sub_amount, 0) ELSE 0 END) AS ut
       FROM am GROUP BY source, agency_number, agency_name, prime_vendor)
SELECT {prime_cols},
       {money(f"CASE WHEN {qual('p.prime_certification_type')} THEN CASE WHEN st.ut > 0 THEN p.prime_total_amount - st.ut ELSE p.prime_total_amount END ELSE COALESCE(st.ct, 0) END")} AS certified_spend,
       {_NULL_SUBS}, NULL::VARCHAR AS match_method
FROM pc p LEFT JOIN st ON {_P4.format(a='st', b='p')}
UNION ALL
SELECT p.source, p.agency_number, p.agency_name, p.prime_vendor, p.sub_business_name, 'SUBCONTRACTOR',
       {_PRIME_INFO}, NULL::DECIMAL(38,2), NULL::DECIMAL(38,2),
       p.sub_b2g_id, p.s_tax, p.sub_certification_type, p.sub_matched_tax_id, p.sub_matched_b2g_id,
       p.sub_match_method, p.sub_audit_period, {money('p.sub_amount')}, p.match_method
FROM am p""", ["pc", "cs"])


# ---- M15 prime cert summary, M16 unmatched contract primes
cte("css", ["contract_prime_summary", "contract_totals2"], f"""
  SELECT c.*, (SELECT MIN(ct.tax_id) FROM contract_totals2 ct
               WHERE ct.prime_vendor = c.prime_vendor AND ct.agency_name = c.agency_name
                 AND UPPER(TRIM(ct.vendor_type)) = 'PRIME') AS prime_tax_id,
         {canon_b('c.prime_vendor')} AS c_cpv, {canon_b('c.agency_name')} AS c_can
  FROM contract_prime_summary c""")
_G9 = ("p.source, p.agency_number, p.agency_name, p.prime_vendor, p.prime_tax_id, p.prime_certification_type, "
       "p.prime_matched_tax_id, p.prime_match_method, p.prime_total_amount")
_SUMS = ("SUM(c.total_subs_amount) AS tsa, SUM(c.certified_subs_spend) AS csa, "
         "SUM(c.uncertified_subs_spend) AS usa, SUM(c.sub_count) AS sc")
cte("ps_tax", ["pc", "css"], f"""
  SELECT {_G9}, {_SUMS}, 'tax_id' AS mm FROM pc p JOIN css c
    ON CAST(p.prime_matched_tax_id AS VARCHAR) = CAST(c.prime_tax_id AS VARCHAR) AND p.can = c.c_can
  GROUP BY {_G9}""")
cte("ps_name", ["pc", "css", "ps_tax"], f"""
  SELECT {_G9}, {_SUMS}, 'name' AS mm FROM pc p JOIN css c ON p.cpv = c.c_cpv AND p.can = c.c_can
  WHERE NOT EXISTS (SELECT 1 FROM ps_tax m WHERE {_P4.format(a='m', b='p')})
  GROUP BY {_G9}""")
cte("prime_cert_summary", ["pc", "ps_tax", "ps_name"], f"""
  SELECT {_G9.replace('p.prime_total_amount', money('p.prime_total_amount') + ' AS prime_total_amount')},
         {money('COALESCE(m.tsa, 0)')} AS total_subs_amount, {money('COALESCE(m.csa, 0)')} AS certified_subs_spend,
         {money('COALESCE(m.usa, 0)')} AS uncertified_subs_spend, CAST(COALESCE(m.sc, 0) AS BIGINT) AS sub_count,
         m.mm AS match_method,
         {money(f"CASE WHEN {qual('p.prime_certification_type')} THEN CASE WHEN COALESCE(m.usa, 0) > 0 THEN p.prime_total_amount - m.usa ELSE p.prime_total_amount END ELSE COALESCE(m.csa, 0) END")} AS total_certified_spend
  FROM pc p LEFT JOIN (SELECT * FROM ps_tax UNION ALL SELECT * FROM ps_name) m ON {_P4.format(a='m', b='p')}""")
cte("unmatched_contract_primes", ["css", "pc"], """
  SELECT c.prime_vendor, c.agency_name, c.prime_tax_id, c.total_subs_amount, c.certified_subs_spend,
         c.uncertified_subs_spend, c.sub_count
  FROM css c
  WHERE NOT EXISTS (SELECT 1 FROM pc p
                    WHERE (c.prime_tax_id IS NOT NULL AND p.prime_matched_tax_id IS NOT NULL
                           AND CAST(c.prime_tax_id AS VARCHAR) = CAST(p.prime_matched_tax_id AS VARCHAR)
                           AND c.c_can = p.can)
                       OR (c.c_cpv = p.cpv AND c.c_can = p.can))""")



# ---- sheet sync pair (customer -> incoming snapshot and existing target)
RUN_TS = "TIMESTAMP '2025-01-02 03:04:05'"
OLD_TS = "TIMESTAMP '2024-01-01 00:00:00'"


def _hash_sql(key: str, name: str, nation: str, bal: str, seg: str) -> str:
    """md5 of '|'-joined canonical values (strip text, %.10g for doubles, '' for NULL)."""
    return (f"md5(concat_ws('|', COALESCE(TRIM({key}), ''), COALESCE(TRIM({name}), ''), "
            f"COALESCE(CAST({nation} AS VARCHAR), ''), COALESCE(printf('%.10g', {bal}), ''), "
            f"COALESCE(TRIM({seg}), '')))")


cte("sync_raw", [], """
  SELECT CASE WHEN c_custkey % 101 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey,
         c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer""")
cte("sync_in", ["sync_raw"], f"""
  SELECT TRIM(c_custkey) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
         {_hash_sql('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment')} AS row_hash,
         {RUN_TS} AS updated_at
  FROM sync_raw WHERE c_custkey IS NOT NULL AND TRIM(c_custkey) <> ''""")
cte("sync_target", [], f"""
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, {OLD_TS} AS created_at, {OLD_TS} AS updated_at,
         CASE WHEN frozen THEN NULL
              ELSE {_hash_sql('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment')} END AS row_hash
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey,
               CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
               c_custkey % 53 = 0 AS frozen
        FROM customer WHERE c_custkey % 7 <> 0
        UNION ALL
        SELECT CAST(c_custkey + 1000000 AS VARCHAR), c_name, c_nationkey, c_acctbal, c_mktsegment, FALSE
        FROM customer WHERE c_custkey % 10 = 3) x""")
_SYNC_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def _sync_sql(created_on_update: str, delete: bool = True, upsert: bool = True) -> str:
    ins = f"SELECT {_SYNC_COLS}, {RUN_TS} AS created_at, {RUN_TS} AS updated_at, row_hash FROM sync_in i WHERE NOT EXISTS (SELECT 1 FROM sync_target t WHERE t.c_custkey = i.c_custkey)"
    upd = (f"SELECT i.c_custkey, i.c_name, i.c_nationkey, i.c_acctbal, i.c_mktsegment, {created_on_update}, "
           f"{RUN_TS}, i.row_hash FROM sync_target t JOIN sync_in i ON t.c_custkey = i.c_custkey "
           "WHERE t.row_hash <> i.row_hash")
    same = ("SELECT t.* FROM sync_target t JOIN sync_in i ON t.c_custkey = i.c_custkey "
            "WHERE t.row_hash IS NULL OR t.row_hash = i.row_hash")
    gone = ("SELECT t.* FROM sync_target t WHERE NOT EXISTS (SELECT 1 FROM sync_in i WHERE i.c_custkey = t.c_custkey)")
    if delete:
        gone += " AND (t.row_hash IS NULL OR EXISTS (SELECT 1 FROM sync_in i WHERE i.row_hash = t.row_hash))"
    if not upsert:
        # delete only: every target row whose hash survives
        return query("SELECT * FROM sync_target t WHERE t.row_hash IS NULL OR EXISTS "
                     "(SELECT 1 FROM sync_in i WHERE i.row_hash = t.row_hash)", ["sync_target", "sync_in"])
    return query(f"{ins}\nUNION ALL\n{upd}\nUNION ALL\n{same}\nUNION ALL\n{gone}", ["sync_target", "sync_in"])


SYNC_UPSERT_FIRST = _sync_sql("t.created_at")
SYNC_DELETE_FIRST = _sync_sql(RUN_TS)
SYNC_UPSERT_ONLY = _sync_sql("t.created_at", delete=False)
SYNC_DELETE_ONLY = _sync_sql("t.created_at", upsert=False)
SYNC_STATS = query("""
, ops AS (
  SELECT CASE WHEN t.c_custkey IS NULL THEN 'insert'
              WHEN i.c_custkey IS NOT NULL AND t.row_hash IS NULL THEN 'frozen'
              WHEN i.c_custkey IS NOT NULL AND t.row_hash = i.row_hash THEN 'unchanged'
              WHEN i.c_custkey IS NOT NULL THEN 'update'
              WHEN t.row_hash IS NULL OR EXISTS (SELECT 1 FROM sync_in h WHERE h.row_hash = t.row_hash) THEN 'orphan'
              ELSE 'delete' END AS op
  FROM sync_target t FULL OUTER JOIN sync_in i ON t.c_custkey = i.c_custkey)
SELECT 'dropped' AS stat, (SELECT COUNT(*) FROM sync_raw WHERE c_custkey IS NULL OR TRIM(c_custkey) = '') AS value
UNION ALL SELECT 'duplicate_hashes', (SELECT COUNT(*) - COUNT(DISTINCT row_hash) FROM sync_in)
UNION ALL SELECT 'upserted', (SELECT COUNT(*) FROM ops WHERE op IN ('insert', 'update'))
UNION ALL SELECT 'deleted', (SELECT COUNT(*) FROM ops WHERE op = 'delete')
UNION ALL SELECT op, COUNT(*) FROM ops GROUP BY op""", ["sync_target", "sync_in", "sync_raw"])

# ---- districts and surrogate keys
cte("districts", [], """
  SELECT 'District ' || CAST(c_nationkey AS VARCHAR) AS district, CAST(c_custkey AS VARCHAR) AS zipcode,
         CASE c_custkey % 3 WHEN 1 THEN 'Split' WHEN 2 THEN 'Whole' END AS split_whole_combined
  FROM customer""")
_ZIP5 = "CASE WHEN length(zipcode) < 5 THEN lpad(zipcode, 5, '0') ELSE zipcode END"
SURROGATE_IDS = query(f"""
SELECT district, zipcode, split_whole_combined, {_ZIP5} AS zipcode5,
       district || '-' || lower(substr(replace(to_base64(encode(upper(
           district || '|' || {_ZIP5} || '|' || COALESCE(split_whole_combined, '')))), '=', ''), 1, 12)) AS unique_id
FROM districts""", ["districts"])

# ---- fixed-width report lines (built from lineitem x supplier), parsed with RE2
cte("fw_lines", [], """
  SELECT 'file_' || CAST(l_orderkey % 4 AS VARCHAR) AS file_stem, l_orderkey, l_linenumber,
    CASE l_orderkey % 5
      WHEN 0 THEN '1' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || s_name || ' '
                  || lpad(CAST(s_suppkey + 100000000 AS VARCHAR), 9, '0') || ' AB '
                  || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' 2513'
      WHEN 1 THEN '2' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || s_name || ' '
                  || lpad(CAST(s_suppkey + 100000000 AS VARCHAR), 9, '0') || 'XY'
                  || lpad(CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS DECIMAL(18,0)) AS VARCHAR), 13, '0')
                  || '2513'
      WHEN 2 THEN '1' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || s_name || ' '
                  || lpad(CAST(s_suppkey + 100000000 AS VARCHAR), 9, '0') || ' 99 '
                  || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' 2513'
      WHEN 3 THEN '  1' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || s_name || ' '
                  || lpad(CAST(s_suppkey + 100000000 AS VARCHAR), 9, '0') || ' AB '
                  || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' 2513' || chr(9) || ' '
      ELSE '' END AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
cte("fw_a", ["fw_lines"], r"""
  SELECT file_stem, l_orderkey, l_linenumber, value, line, substr(line, 6) AS rest,
         regexp_extract(substr(line, 6), '^(.*?)(\d{9})\s*[A-Z]{2}', 2) AS fed1,
         regexp_extract(substr(line, 6), '^(.*?)(\d{9})\s*[A-Z]{2}', 1) AS pre1,
         regexp_extract(substr(line, 6), '^(.*?)(\d{9})', 2) AS fed2,
         regexp_extract(substr(line, 6), '^(.*?)(\d{9})', 1) AS pre2
  FROM (SELECT *, regexp_replace(value, '^\s+|\s+$', '', 'g') AS line FROM fw_lines) x""")
cte("fw_b", ["fw_a"], r"""
  SELECT *, CASE WHEN fed1 <> '' THEN fed1 WHEN fed2 <> '' THEN fed2 END AS fed_id,
         CASE WHEN fed1 <> '' THEN pre1 ELSE pre2 END AS prefix
  FROM fw_a""")
cte("fw_c", ["fw_b"], r"""
  SELECT *, regexp_replace(substr(rest, length(prefix) + 10), '^\s+|\s+$', '', 'g') AS after FROM fw_b""")
cte("fw_parsed", ["fw_c"], r"""
  SELECT file_stem, l_orderkey, l_linenumber, value,
         substr(line, 1, 1) AS report_part,
         CASE WHEN length(line) > 4 THEN substr(line, 2, 4) ELSE '' END AS college_number,
         regexp_replace(prefix, '^\s+|\s+$', '', 'g') AS firm_name,
         fed_id AS firm_fed_id,
         CASE WHEN regexp_extract(after, '^\s*([A-Z]{2})', 1) <> '' THEN regexp_extract(after, '^\s*([A-Z]{2})', 1)
              WHEN regexp_extract(after, '([A-Z]{2})', 1) <> '' THEN regexp_extract(after, '([A-Z]{2})', 1) END
           AS sub_object,
         CASE WHEN regexp_extract(after, '(\d+\.\d{2})', 1) <> '' THEN regexp_extract(after, '(\d+\.\d{2})', 1)
              WHEN regexp_extract(after, '(\d{5,})', 1) <> '' THEN
                left(regexp_extract(after, '(\d{5,})', 1), length(regexp_extract(after, '(\d{5,})', 1)) - 2)
                || '.' || right(regexp_extract(after, '(\d{5,})', 1), 2) END AS dollar_amount,
         substr(regexp_extract(line, '(\d{4})$', 1), 1, 2) AS fiscal_year,
         '13' AS fiscal_month,
         line = '' AS is_blank
  FROM fw_c""")
cte("fw_flagged", ["fw_parsed"], """
  SELECT *, (NOT is_blank AND firm_fed_id IS NOT NULL AND sub_object IS NOT NULL AND dollar_amount IS NOT NULL)
              AS is_parsed
  FROM fw_parsed""")


# ---- R4 profile of the raw test tables: (table, ordinal, column, Spark type, rows, NULLs)
# the driver's tables: column name and type, in order
PROFILE_TABLES = {t: [tuple(c.split(" ")) for c in cols.split(", ")] for t, cols in {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}.items()}


def profile_sql(tables: dict[str, list[tuple[str, str]]] = PROFILE_TABLES) -> str:
    parts = []
    for t, cols in tables.items():
        for i, (c, ty) in enumerate(cols, start=1):
            parts.append(f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, "
                         f"'{ty}' AS data_type, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) "
                         f"AS null_count FROM {t}")
    return "\nUNION ALL\n".join(parts)


def preview_sql(n: int = 5, tables: dict[str, list[tuple[str, str]]] = PROFILE_TABLES) -> str:
    parts = []
    for t, cols in tables.items():
        order = ", ".join(f"{c} ASC NULLS FIRST" for c, ty in cols if not ty.startswith("array"))
        for i, (c, ty) in enumerate(cols, start=1):
            cell = f"len({c})" if ty.startswith("array") else c
            parts.append(f"SELECT '{t}' AS table_name, CAST(rn AS INTEGER) AS row_no, CAST({i} AS INTEGER) AS ordinal, "
                         f"'{c}' AS column_name, CAST({cell} AS VARCHAR) AS cell FROM "
                         f"(SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM {t}) x WHERE rn <= {n}")
    return "\nUNION ALL\n".join(parts)


# ---- S2: whole-number doubles become integers, text stays text
INFER_TYPES = query("""
SELECT row_id, source, CAST(agency_number AS BIGINT) AS agency_number, agency_name, business_name, tax_id,
       CAST(total_amount AS DOUBLE) AS total_amount
FROM agency_spend""", ["agency_spend"])
