"""SQL that gives the same rows as each query, for an independent engine.

The statements are written from the meaning of the checks, not from the Spark
plans: joins where the plans aggregate, all pairs where the plans use an index.
"""

from __future__ import annotations

ORDERS_WITH_GAPS = """(
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS o_custkey,
           o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(NULL AS VARCHAR) AS o_comment
    FROM orders)"""

ORDERS_WITH_TEXT_DATES = """(
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
                WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
    FROM orders)"""

SOLVENT = "(SELECT * FROM customer WHERE c_acctbal > 0)"

DICTIONARY = """(
    SELECT lower(trim(column_name, ' ' || chr(160))) AS column_name, "Description", source_sheet
    FROM (SELECT CASE WHEN p_size > 40 THEN p_name
                      WHEN p_size > 1 THEN '  ' || upper(p_name) || chr(160) END AS column_name,
                 p_type AS "Description", 'part' AS source_sheet FROM part
          UNION ALL
          SELECT replace(s_name, '#', ''), 'a supplier', 'supplier' FROM supplier
          UNION ALL
          SELECT c_name || ' ', c_mktsegment, 'customer' FROM customer))"""

CUSTOMER_SCHEMA = """(
    SELECT lower(c_name) AS column_name,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'int' WHEN 'MACHINERY' THEN 'double'
                ELSE 'string' END AS column_type
    FROM customer WHERE c_acctbal > 0)"""


def _status(inner: str) -> str:
    """Violations of a check and its status, from a query for the violations."""
    return (
        "SELECT CAST(violations AS BIGINT) AS violations, "
        "CASE WHEN violations = 0 THEN 'Passed' ELSE 'Failed' END AS status "
        f"FROM ({inner}) AS counted"
    )


def _count(table: str, bad: str) -> str:
    return _status(f"SELECT count(*) FILTER (WHERE {bad}) AS violations FROM {table}")


def _any(column: str, *words: str) -> str:
    return " OR ".join(f"contains({column}, '{w}')" for w in words)


# The keywords of the business categories, in order of precedence.
CATEGORY = f"""CASE
    WHEN {_any('t', 'loan', 'application', 'purpose', 'policy')} THEN 'loan_info'
    WHEN {_any('t', 'fico', 'delinq', 'inq', 'credit', 'risk')} THEN 'credit_info'
    WHEN {_any('t', 'income', 'amount', 'balance', 'funded', 'bc_util', 'cur_bal')} THEN 'financial_metrics'
    WHEN {_any('t', 'pymnt', 'installment', 'total', 'rec', 'out_prncp')} THEN 'payment_info'
    WHEN {_any('t', 'emp', 'job', 'employer', 'title')} THEN 'employment_info'
    WHEN {_any('t', 'date', 'month', 'issue', 'last', 'start', 'end')} THEN 'dates'
    WHEN {_any('t', 'state', 'zip', 'addr')} THEN 'geographic_info'
    WHEN {_any('t', 'hardship', 'settlement', 'debt', 'deferral')} THEN 'special_cases'
    ELSE 'other' END"""

CLASS = f"""CASE
    WHEN {_any('t', 'income', 'amount', 'balance')} THEN 'funds'
    WHEN {_any('t', 'employer', 'job', 'title')} THEN 'customer details'
    WHEN {_any('t', 'status', 'default', 'delinquency')} THEN 'status'
    WHEN {_any('t', 'date', 'month')} THEN 'dates'
    WHEN {_any('t', 'state', 'zip')} THEN 'geographic location'
    ELSE 'other' END"""

MAPPING = f"""(
    SELECT 'doc_' || d.doc_id AS column_name, {CATEGORY} AS category,
           CASE lang WHEN 'de' THEN 'int' WHEN 'fr' THEN 'double' WHEN 'es' THEN 'date'
                ELSE 'string' END AS column_type,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS is_required
    FROM (SELECT doc_id, lang, lower(text) AS t FROM documents) d)"""

_TEST_CONDITIONS = {
    "check_nulls": "true",
    "check_consistency": "true",
    "dtype_consistency": "true",
    "count_records": "true",
    "validate_numeric_range": "column_type IN ('int', 'double')",
    "validate_sum": "column_type IN ('int', 'double')",
    "check_duplicates": "column_type IN ('int', 'double') OR category = 'credit_info'",
    "validate_allowed_values": "column_type = 'string'",
    "validate_values_length": "column_type = 'string'",
    "validate_date_format": "category = 'dates'",
    "validate_date_range": "category = 'dates'",
    "file_timeliness": "category = 'dates'",
    "moving_average": "category = 'financial_metrics'",
    "check_foreign_key": "category = 'loan_info'",
    "duplicated_files_by_name_and_size": "category = 'special_cases'",
    "find_duplicate_columns": "category = 'special_cases'",
}
TESTS_OF_COLUMNS = "(" + " UNION ALL ".join(
    f"SELECT column_name, category, is_required, '{test}' AS test_function FROM mapping WHERE {condition}"
    for test, condition in _TEST_CONDITIONS.items()
) + ")"

_ROW_RULES = """(
    SELECT o_orderkey,
           CASE WHEN o_custkey IS NULL THEN 'T01' END AS r1,
           CASE WHEN o_totalprice < 2000 OR o_totalprice > 400000 THEN 'T04' END AS r4,
           CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' - INTERVAL 364 DAY
                  OR o_orderdate > TIMESTAMP '2000-01-01' THEN 'T07' END AS r7
    FROM {orders})""".format(orders=ORDERS_WITH_GAPS)


def _rule(tcid: str, file: str, test: str, field: str | None, violations: str) -> str:
    shown = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{tcid}' AS tcid, '{file}' AS file_name, '{test}' AS test, {shown} AS tested_field, "
        f"CASE WHEN v = 0 THEN 'Passed' ELSE 'Failed' END AS status, CAST(v AS BIGINT) AS violations "
        f"FROM (SELECT {violations} AS v)"
    )


def _plain(tcid: str, file: str, test: str, field: str | None, status: str) -> str:
    shown = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{tcid}', '{file}', '{test}', {shown}, '{status}', CAST(-1 AS BIGINT)"
    )


_RULES = {
    "T01": ("orders", "check_nulls", "o_custkey",
            f"(SELECT count(*) FROM {ORDERS_WITH_GAPS} WHERE o_custkey IS NULL)"),
    "T02": ("orders", "count_records", None, "(SELECT abs(count(*) - 15000) FROM orders)"),
    "T03": ("orders", "check_duplicates", "o_orderkey",
            "(SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))"),
    "T04": ("orders", "validate_numeric_range", "o_totalprice",
            "(SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 2000 AND 400000)"),
    "T05": ("orders", "validate_allowed_values", "o_orderstatus",
            "(SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P'))"),
    "T06": ("orders", "check_foreign_key", "o_custkey",
            f"(SELECT count(*) FROM {ORDERS_WITH_GAPS} o WHERE o_custkey IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM customer WHERE c_custkey = o.o_custkey))"),
    "T07": ("orders", "validate_date_range", "o_orderdate",
            f"(SELECT count(*) FROM {_ROW_RULES} WHERE r7 IS NOT NULL)"),
    "T09": ("customer", "validate_values_length", "c_mktsegment",
            "(SELECT count(*) FROM customer WHERE length(c_mktsegment) > 9)"),
    "T10": ("customer", "validate_sum", "c_acctbal",
            "(SELECT CASE WHEN sum(CAST(c_acctbal AS DECIMAL(18,2))) = 1 THEN 0 ELSE 1 END FROM customer)"),
    "T11": ("customer", "dtype_consistency", "c_name",
            "(SELECT count(*) FROM customer WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS INTEGER) IS NULL)"),
    "T12": ("customer", "check_nulls", "c_custkey",
            "(SELECT count(*) FROM customer WHERE c_custkey IS NULL)"),
    "T15": ("lineitem", "check_consistency", "l_returnflag",
            "(SELECT count(*) FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_returnflag <> b.l_returnflag)"),
    "T16": ("lineitem", "validate_numeric_range", "l_discount",
            "(SELECT count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.08)"),
}
_BROKEN = {
    "T13": ("customer", "check_nulls", "c_missing"),
    "T14": ("customer", "no_such_test", "c_name"),
}
STATUS_TABLE = " UNION ALL ".join(
    [_rule(t, *parts) for t, parts in _RULES.items()]
    + [_plain(t, *parts, "Error") for t, parts in _BROKEN.items()]
)
STOPPED = " UNION ALL ".join(
    [_rule(t, *_RULES[t]) for t in ("T01", "T12")]
    + [_plain(t, *parts[:3], "Skipped") for t, parts in _RULES.items() if t not in ("T01", "T12")]
    + [_plain(t, *parts, "Skipped") for t, parts in _BROKEN.items()]
)
DIMENSION = """CASE
    WHEN test IN ('check_nulls', 'count_records') THEN 'Completeness'
    WHEN test = 'check_duplicates' THEN 'Uniqueness'
    WHEN test IN ('check_consistency', 'dtype_consistency') THEN 'Consistency'
    WHEN test = 'check_foreign_key' THEN 'Foreign Key'
    WHEN test IN ('validate_numeric_range', 'validate_allowed_values', 'validate_values_length') THEN 'Validations'
    WHEN test = 'validate_date_range' THEN 'Freshness'
    WHEN test = 'validate_sum' THEN 'Accuracy' END"""

_TRAILING = """(
    SELECT o_orderkey, o_totalprice,
           avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                                   ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS m
    FROM orders)"""

_LINEITEM_COLUMNS = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)

_LCS = """list_reduce(string_split(a, ''),
    lambda prev, x: list_reduce(string_split(b, ''),
        lambda acc, y: list_append(acc, CASE WHEN x = y THEN prev[len(acc)] + 1
                                             ELSE greatest(acc[-1], prev[len(acc) + 1]) END), [0]),
    list_transform(range(length(b) + 1), lambda z: 0))[-1]"""


def _best(names: str, choices: str) -> str:
    """The most similar choice per name, over all pairs (words need no sorting here)."""
    return f"""
    WITH n AS (SELECT DISTINCT {names} AS a FROM part), c AS ({choices}),
    near AS (SELECT a, b, length(a) + length(b) AS total FROM n, c
             WHERE 10 * levenshtein(a, b) <= length(a) + length(b)),
    scored AS (SELECT a, b, total, total - 2 * {_LCS} AS d FROM near),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d / total, b) AS place
               FROM scored WHERE 10 * d <= total)
    SELECT a AS name, b AS matched, round(100 * (1 - d / total), 6) AS score
    FROM ranked WHERE place = 1"""


def _same_values(a: str, b: str) -> str:
    return (
        f"SELECT '{b}' AS column_name, '{a}' AS duplicate_of WHERE NOT EXISTS "
        f"(SELECT {a} FROM copies EXCEPT ALL SELECT {b} FROM copies)"
    )


def _same_rows(a: str, b: str) -> str:
    return (
        f"SELECT '{b}' AS column_name, '{a}' AS duplicate_of WHERE NOT EXISTS "
        f"(SELECT 1 FROM copies WHERE {a} IS DISTINCT FROM {b})"
    )


COPIES = """WITH copies AS (
    SELECT *, o_orderkey AS key_copy, o_orderpriority AS priority_copy,
           xor(o_orderkey, 1) AS key_swapped FROM orders) """

_COPY_PAIRS = (
    ("o_orderkey", "o_custkey"), ("o_orderkey", "key_copy"), ("o_orderkey", "key_swapped"),
    ("o_custkey", "key_copy"), ("o_custkey", "key_swapped"),
    ("o_orderstatus", "o_orderpriority"), ("o_orderstatus", "priority_copy"),
    ("o_orderpriority", "priority_copy"),
)



def _least_equal(column: str) -> str:
    """The first by name of the columns with the values of this one, if there is another."""
    others = {column}
    for _ in _COPY_PAIRS:
        others |= {c for pair in _COPY_PAIRS if others & set(pair) for c in pair}
    others -= {column}
    listed = [f"SELECT '{column}' AS o"] + [
        f"SELECT '{o}' AS o WHERE NOT EXISTS (SELECT {o} FROM copies EXCEPT ALL SELECT {column} FROM copies)"
        for o in sorted(others)
    ]
    return (
        f"SELECT '{column}' AS column_name, min(o) AS same_as FROM ({' UNION ALL '.join(listed)}) HAVING count(*) > 1"
    )


# The keys, references and comparisons of the suite of keyed rules.
_KEYS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag",
    "l_orderkey, l_linenumber", "l_orderkey, l_partkey", "l_orderkey, l_suppkey", "l_partkey, l_suppkey",
    "l_partkey, l_linenumber", "l_suppkey, l_linenumber", "l_orderkey, l_shipdate", "l_partkey, l_shipdate",
    "l_orderkey, l_quantity", "l_orderkey, l_extendedprice", "l_returnflag, l_linestatus",
    "l_orderkey, l_partkey, l_suppkey", "l_orderkey, l_linenumber, l_shipdate",
)


def _shared_scan_rules() -> list[str]:
    """Each rule by a query of its own: groups, anti joins and joins."""
    rules = [
        ("check_duplicates", keys, f"(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY {keys} HAVING count(*) > 1))")
        for keys in _KEYS
    ]
    for column in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"):
        for listed in (
            "SELECT o_custkey FROM orders", "SELECT p_partkey FROM part", "SELECT s_suppkey FROM supplier",
            "SELECT c_custkey FROM customer", "SELECT o_orderkey FROM orders",
        ):
            rules.append(("check_foreign_key", column, f"(SELECT count(*) FROM lineitem WHERE {column} NOT IN ({listed}))"))
    for one, two in (
        ("l_linestatus", "o_orderstatus"), ("l_returnflag", "o_orderstatus"), ("l_extendedprice", "o_totalprice"),
        ("l_shipdate", "o_orderdate"), ("l_partkey", "o_custkey"),
    ):
        pairs = f"(SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {one} <> {two})"
        rules.append(("check_consistency", f"{one}, {two}", pairs))
    return [_rule(f"K{i:02d}", "lineitem", t, f, c) for i, (t, f, c) in enumerate(rules)]


ORACLE: dict[str, str] = {
    "null_count": _count(ORDERS_WITH_GAPS, "o_custkey IS NULL"),
    "row_count": _status("SELECT abs(count(*) - 50000) AS violations FROM lineitem"),
    "duplicate_keys": """
        SELECT count(*) AS dup_groups, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "duplicate_check": _status(
        "SELECT count(*) AS violations FROM (SELECT 1 FROM orders "
        "GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)"
    ),
    "duplicate_key_groups": """
        SELECT text, lang, count(*) AS copies FROM documents GROUP BY text, lang HAVING count(*) > 1""",
    "column_fingerprint": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 15) "
        f"AS BIGINT)) AS VARCHAR) AS fp FROM lineitem"
        for c, _ in _LINEITEM_COLUMNS
    ),
    "duplicate_columns": COPIES + " UNION ALL ".join(_same_rows(a, b) for a, b in _COPY_PAIRS),
    "duplicate_columns_any_order": COPIES
    + " UNION ALL ".join(_same_values(a, b) for a, b in _COPY_PAIRS),
    "consistency_check": _status("""
        SELECT count(*) AS violations FROM orders a
        JOIN (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
              FROM orders) b USING (o_orderkey)
        WHERE a.o_orderstatus <> b.o_orderstatus"""),
    "consistency_two_columns": _status("""
        SELECT count(*) AS violations FROM customer a
        JOIN (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_nationkey + 1 ELSE c_nationkey END AS home_nation
              FROM customer) b USING (c_custkey)
        WHERE a.c_nationkey <> b.home_nation"""),
    "consistency_many_to_many": """
        SELECT a.l_orderkey, count(*) AS mismatched_pairs
        FROM lineitem a JOIN lineitem b USING (l_orderkey)
        WHERE a.l_returnflag <> b.l_returnflag GROUP BY a.l_orderkey""",
    "consistency_with_nulls": _status(f"""
        SELECT count(*) AS violations FROM orders a JOIN {ORDERS_WITH_GAPS} b USING (o_orderkey)
        WHERE a.o_custkey IS DISTINCT FROM b.o_custkey"""),
    "foreign_key": _status(f"""
        SELECT count(*) AS violations FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM {SOLVENT})"""),
    "foreign_key_values": f"""
        SELECT o_custkey, count(*) AS row_count FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM {SOLVENT}) GROUP BY o_custkey""",
    "foreign_key_rows": f"""
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM {SOLVENT})""",
    "foreign_key_mixed_types": """
        SELECT o_custkey, count(*) AS row_count FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 <> 0) GROUP BY o_custkey""",
    "allowed_values_table": _status("""
        SELECT count(*) AS violations FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)"""),
    "nested_nulls": _count(ORDERS_WITH_GAPS, "o_custkey IS NULL"),
    "checksum_groups": COPIES + " UNION ALL ".join(_least_equal(c) for c in sorted({c for p in _COPY_PAIRS for c in p})),
    "dtype_consistency": _count(
        "(SELECT CASE WHEN p_brand = 'Brand#4' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part)",
        "p_size IS NOT NULL AND TRY_CAST(p_size AS INTEGER) IS NULL",
    ),
    "numeric_range": """
        SELECT count(*) FILTER (WHERE o_totalprice < 2000) AS below,
               count(*) FILTER (WHERE o_totalprice > 400000) AS above,
               count(*) FILTER (WHERE o_totalprice < 2000 OR o_totalprice > 400000) AS violations
        FROM orders""",
    "char_length": _count("customer", "length(c_mktsegment) > 9"),
    "decimal_length": _count(
        "lineitem",
        "length(CAST(l_extendedprice AS VARCHAR)) > 7 OR "
        "TRY_CAST(TRY_CAST(l_extendedprice AS DECIMAL(10,0)) AS DECIMAL(7,2)) IS NULL",
    ),
    "integer_length": _count(
        f"(SELECT CAST(o_custkey AS VARCHAR) AS o_custkey FROM {ORDERS_WITH_GAPS})",
        "TRY_CAST(o_custkey AS INTEGER) IS NULL",
    ),
    "allowed_values": _count("events", "event_type NOT IN ('click', 'view', 'purchase')"),
    "date_format": _count(
        ORDERS_WITH_TEXT_DATES, "try_strptime(o_orderdate, '%Y-%m-%d') IS NULL"
    ),
    "date_format_ignoring_nulls": _count(
        ORDERS_WITH_TEXT_DATES,
        "o_orderdate IS NOT NULL AND try_strptime(o_orderdate, '%Y-%m-%d') IS NULL",
    ),
    "timestamp_format": _count(
        """(SELECT CASE WHEN event_type = 'error' THEN strftime(ts, '%Y/%m/%d %H:%M')
                        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events)""",
        "try_strptime(ts, '%Y-%m-%d %H:%M:%S') IS NULL",
    ),
    "date_range": """
        SELECT count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-25' - INTERVAL 7 DAY) AS late,
               count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-25') AS future,
               count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-25' - INTERVAL 7 DAY
                                   OR ts > TIMESTAMP '2024-01-25') AS violations
        FROM events""",
    "control_sum": """
        SELECT CAST(total AS DOUBLE) AS actual,
               CASE WHEN total = 1000000 THEN 'Passed' ELSE 'Failed' END AS status
        FROM (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem)""",
    "control_table": """
        SELECT 'l_quantity' AS tested_field, CASE WHEN s = (SELECT sum(q) FROM (
                   SELECT sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY l_orderkey))
               THEN 'Passed' ELSE 'Failed' END AS status
        FROM (SELECT sum(CAST(l_quantity AS DECIMAL(18,2))) AS s FROM lineitem)
        UNION ALL
        SELECT 'l_tax', CASE WHEN s = s + 1 THEN 'Passed' ELSE 'Failed' END
        FROM (SELECT sum(CAST(l_tax AS DECIMAL(18,2))) AS s FROM lineitem)""",
    "moving_average": f"""
        SELECT o_orderkey, round(m, 4) AS moving_avg,
               round(CASE WHEN m IS NOT NULL AND m <> 0 THEN abs(o_totalprice - m) / abs(m) * 100 ELSE 0 END, 6)
                   AS deviation
        FROM {_TRAILING}""",
    "highest_deviation": f"""
        SELECT round(max(d), 6) AS highest, count(*) FILTER (WHERE d > 150) AS bad
        FROM (SELECT CASE WHEN m IS NOT NULL AND m <> 0 THEN abs(o_totalprice - m) / abs(m) * 100 ELSE 0 END AS d
              FROM {_TRAILING})""",
    "moving_average_check": _count(_TRAILING, "m <> 0 AND abs(o_totalprice - m) / abs(m) * 100 > 150"),
    "iqr_outliers": _status("""
        SELECT count(*) AS violations FROM lineitem,
            (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b
             FROM lineitem)
        WHERE l_extendedprice < a - 0.75 * (b - a) OR l_extendedprice > b + 0.75 * (b - a)"""),
    "exact_float_sum": """
        WITH w AS (
            SELECT (l_extendedprice * 35184372088832.0)::HUGEINT AS p, l_linenumber AS k, l_returnflag AS f FROM lineitem)
        SELECT 'spread' AS column_name, sum(p * (1::HUGEINT << (5 * (k - 1))))::VARCHAR AS units FROM w
        UNION ALL
        SELECT 'signed', (32768 * sum(CASE WHEN f = 'R' THEN -p ELSE p END))::VARCHAR FROM w""",
    "iqr_fences_all": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high "
        f"FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS a, quantile_cont({c}::DOUBLE, 0.75) AS b FROM lineitem)"
        for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        )
    ),
    "iqr_fences_nan": """
        WITH v AS (
            SELECT CASE WHEN l_linenumber = 7 OR l_linenumber = 6 OR (l_linenumber = 5 AND l_returnflag = 'R') THEN NULL
                        ELSE l_extendedprice END AS v FROM lineitem),
        q AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM v)
        SELECT CASE WHEN n = 0 THEN 'Passed' ELSE 'Failed' END AS status, n::BIGINT AS violations
        FROM (SELECT count(*) FILTER (WHERE v IS NULL OR v < a - 0.75 * (b - a) OR v > b + 0.75 * (b - a)) AS n FROM v, q)""",
    "iqr_fences": """
        SELECT round(a - 1.5 * (b - a), 4) AS lower, round(b + 1.5 * (b - a), 4) AS upper,
               (SELECT count(*) FROM orders WHERE o_totalprice < a - 1.5 * (b - a)
                                               OR o_totalprice > b + 1.5 * (b - a)) AS n
        FROM (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b
              FROM orders)""",
    "non_null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM {ORDERS_WITH_GAPS}"
        for c in (
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
            "o_orderdate", "o_orderpriority", "o_comment",
        )
    ),
    "empty_columns": f"""
        SELECT 'o_comment' AS column_name WHERE (SELECT count(o_comment) FROM {ORDERS_WITH_GAPS}) = 0
        UNION ALL
        SELECT 'o_custkey' WHERE (SELECT count(o_custkey) FROM {ORDERS_WITH_GAPS}) = 0""",
    "schema_catalog": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, CAST({i} AS INTEGER) AS position, "
        f"count({c}) AS non_null FROM lineitem"
        for i, (c, t) in enumerate(_LINEITEM_COLUMNS)
    ),
    "name_drift": "SELECT count(*) FILTER (WHERE p_size > 40 OR p_size <= 1) AS violations FROM part",
    "dictionary_union": f"SELECT * FROM {DICTIONARY}",
    "type_status": f"""
        SELECT d.*, column_type,
               CASE WHEN column_type IS NULL THEN 'missing' ELSE 'found' END AS type_status
        FROM {DICTIONARY} d LEFT JOIN {CUSTOMER_SCHEMA} s ON d.column_name = s.column_name""",
    "missing_names": f"""
        SELECT DISTINCT d.column_name FROM {DICTIONARY} d
        LEFT JOIN {CUSTOMER_SCHEMA} s ON d.column_name = s.column_name WHERE s.column_name IS NULL""",
    "fuzzy_match": _best(
        "lower(replace(p_name, ' ', '') || '_' || p_brand || '_' || p_type)",
        "SELECT DISTINCT lower(replace(p_name, ' ', '_') || '_' || p_brand || '_' || p_type) AS b "
        "FROM part",
    ),
    "fixed_types": """
        WITH n AS (SELECT lower(replace(s_name, '#', '')) AS a FROM supplier),
        c AS (SELECT lower(s_name) AS b, CASE WHEN s_acctbal < 0 THEN 'int' ELSE 'string' END AS t
              FROM supplier)
        SELECT a AS column_name, b AS column_name_fixed, t AS column_type, 'missing' AS type_status
        FROM n JOIN c ON a = replace(b, '#', '')""",
    "required_flag": """
        SELECT name AS column_name_fixed,
               name IN (SELECT event_type FROM events
                        WHERE event_type <> 'signup' AND value IS NOT NULL) AS is_required
        FROM (SELECT event_type AS name FROM events UNION SELECT c_mktsegment FROM customer)""",
    "business_category": f"""
        SELECT category, count(*) AS n
        FROM (SELECT {CATEGORY} AS category FROM (SELECT lower(text) AS t FROM documents))
        GROUP BY category""",
    "category_rules_table": f"""
        SELECT 'document' AS kind, doc_id AS id, {CATEGORY} AS category
        FROM (SELECT doc_id, coalesce(lower(text), '') AS t FROM documents)
        UNION ALL SELECT 'letter', c_custkey, c_nationkey::VARCHAR FROM customer""",
    "description_class": f"""
        SELECT doc_id, {CLASS} AS category FROM (SELECT doc_id, lower(text) AS t FROM documents)""",
    "test_functions": f"""
        WITH mapping AS (SELECT * FROM {MAPPING})
        SELECT column_name, test_function FROM {TESTS_OF_COLUMNS}""",
    "test_types": f"""
        SELECT column_name, 'stability,completeness' || CASE category
                   WHEN 'dates' THEN ',date_format_validation,timeliness'
                   WHEN 'loan_info' THEN ',accuracy'
                   WHEN 'credit_info' THEN ',credit_score_consistency'
                   WHEN 'employment_info' THEN ',consistency'
                   WHEN 'special_cases' THEN ',custom_validation'
                   WHEN 'other' THEN ',basic_validation' ELSE '' END
               || CASE WHEN column_type IN ('int', 'double') THEN ',range_check' ELSE '' END AS test_types
        FROM {MAPPING}""",
    "focused_mapping": f"""
        SELECT column_name, column_type, category AS business_category FROM {MAPPING} WHERE is_required""",
    "columns_with_test": f"""
        SELECT column_name FROM {MAPPING}
        WHERE is_required AND (column_type IN ('int', 'double') OR category = 'credit_info')""",
    "operational_table": f"""
        WITH mapping AS (SELECT * FROM {MAPPING})
        SELECT column_name, test_function, true AS enabled,
               category IN ('dates', 'special_cases', 'other') AS critical
        FROM {TESTS_OF_COLUMNS} WHERE is_required""",
    "status_table": STATUS_TABLE,
    "status_table_stopped": STOPPED,
    "dimension_rollup": f"""
        SELECT dimension, status, count(*) AS n
        FROM (SELECT {DIMENSION} AS dimension, status FROM ({STATUS_TABLE})) GROUP BY dimension, status""",
    "clean_rows": f"""
        SELECT o_orderkey FROM {_ROW_RULES} WHERE r1 IS NULL AND r4 IS NULL AND r7 IS NULL""",
    "rejected_rows": f"""
        SELECT o_orderkey, concat_ws(',', r1, r4, r7) AS failed_rules FROM {_ROW_RULES}
        WHERE coalesce(r1, r4, r7) IS NOT NULL""",
    "stored_split_clash": f"""
        SELECT o_orderkey, o_orderstatus AS verdict, 2 * o_orderkey AS failed_rules, 'own' AS own
        FROM {_ROW_RULES} JOIN orders USING (o_orderkey) WHERE coalesce(r1, r4, r7) IS NULL""",
    "observed_split": f"""
        SELECT tcid, status, violations FROM ({STATUS_TABLE})
        UNION ALL SELECT 'clean', 'stored', count(*) FROM {_ROW_RULES} WHERE coalesce(r1, r4, r7) IS NULL
        UNION ALL SELECT 'rejected', 'stored', count(*) FROM {_ROW_RULES} WHERE coalesce(r1, r4, r7) IS NOT NULL""",
    "stored_split": f"""
        SELECT o_orderkey, CASE WHEN coalesce(r1, r4, r7) IS NULL THEN 'clean' ELSE 'rejected' END AS verdict
        FROM {_ROW_RULES}""",
    "suite_with_faults": " UNION ALL ".join([
        _rule("T1", "orders", "check_nulls", "o_custkey", f"(SELECT count(*) FROM {ORDERS_WITH_GAPS} WHERE o_custkey IS NULL)"),
        _rule("T1", "lineitem", "check_nulls", "l_orderkey", "(SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)"),
        _plain("none", "orders", "check_nulls", "o_custkey", "Error"),
        _rule("T2", "orders", "validate_sum", "huge", "1"),
        _plain("T3", "orders", "moving_average", "o_totalprice", "Error"),
        _plain("T4", "orders", "check_nulls", "broken", "Error"),
        _plain("T5", "orders", "validate_values_length", "o_orderstatus", "Error"),
        _rule("T6", "lineitem", "validate_sum", "l_quantity", "1"),
        _rule("T7", "lineitem", "validate_allowed_values", "l_partkey",
              "(SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10))"),
    ]),
    "suite_shared_scan": " UNION ALL ".join(_shared_scan_rules()),
    "key_verdicts": f"""
        WITH o AS (SELECT * FROM {ORDERS_WITH_GAPS}),
        v AS (
            SELECT o_orderkey,
                   CASE WHEN count(*) OVER (PARTITION BY o_custkey, o_orderdate) > 1 THEN 'T1' END AS r1,
                   CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'T2' END AS r2,
                   CASE WHEN o_totalprice > 400000 AND o_orderstatus <> 'X' THEN 'T3' END AS r3,
                   CASE WHEN o_custkey IS NULL THEN 'T4' END AS r4
            FROM o)
        SELECT o_orderkey, concat_ws(',', r1, r2, r3, r4) AS failed_rules FROM v WHERE coalesce(r1, r2, r3, r4) IS NOT NULL""",
    "status_report": """
        SELECT 'T1' AS tcid, 'lineitem' AS file_name, 'check_nulls' AS test, 'Passed' AS status,
               'Column ' || chr(39) || 'l_orderkey' || chr(39) || ' does not contain any null values.' AS message
        UNION ALL SELECT 'T2', 'lineitem', 'count_records', 'Failed',
               (SELECT 'Num of records in the file: ' || count(*) || '. Mismatch: the DataFrame has ' || count(*)
                       || ' records, but 1 were expected.' FROM lineitem)
        UNION ALL SELECT 'T3', 'lineitem', 'no_such_test', 'Error',
               'unknown test ' || chr(39) || 'no_such_test' || chr(39)""",
    "csv_suite": """
        SELECT 'T1' AS tcid, CASE WHEN count(*) = 1 THEN 'Passed' ELSE 'Failed' END AS status,
               abs(count(*) - 1)::BIGINT AS violations FROM documents
        UNION ALL SELECT 'T2', CASE WHEN count(*) = 0 THEN 'Passed' ELSE 'Failed' END, count(*)::BIGINT
        FROM documents WHERE text IS NULL
        UNION ALL SELECT 'T3', CASE WHEN count(*) = 0 THEN 'Passed' ELSE 'Failed' END, count(*)::BIGINT
        FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "csv_malformed": """
        WITH l AS (
            SELECT o_orderkey || ',' || o_custkey || CASE o_orderpriority WHEN '2-HIGH' THEN ''
                       WHEN '1-URGENT' THEN ',' || o_orderstatus || ',more' ELSE ',' || o_orderstatus END AS line,
                   o_orderpriority IN ('1-URGENT', '2-HIGH') AS bad, o_orderpriority = '2-HIGH' AS short
            FROM orders)
        SELECT 'line' AS tcid, line AS value FROM l WHERE bad
        UNION ALL SELECT 'T1', CASE WHEN count(*) = 0 THEN 'Passed 0' ELSE 'Failed ' || count(*) END FROM l WHERE bad
        UNION ALL SELECT 'T2', CASE WHEN count(*) = 1 THEN 'Passed 0' ELSE 'Failed ' || abs(count(*) - 1) END FROM l
        UNION ALL SELECT 'T3', CASE WHEN count(*) = 0 THEN 'Passed 0' ELSE 'Failed ' || count(*) END FROM l WHERE short""",
    "csv_roundtrip": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
        FROM documents""",
    "csv_inferred": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderdate FROM orders""",
}
