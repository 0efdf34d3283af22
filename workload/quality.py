"""Quality-rule queries.

Dirty text is derived from typed columns by the same rule in both engines, over
whole tables, so the SQL can apply the intended rule by other means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.compare import frame_diff
from martloom.operators.integrity import (
    duplicate_check,
    merge_registry,
    reference_check,
    split_by_reference,
)
from martloom.operators.rules import (
    REASON,
    Check,
    Outcomes,
    all_outcomes,
    apply_checks,
    date_check,
    decimal_check,
    derive_columns,
    harmonise_check,
    integer_check,
    length_check,
    not_null_check,
    outcomes,
    parse_rules,
    rejects,
    remove_characters,
    rule_checks,
    survivors,
)
from martloom.functions.dates import reformat_date, reformat_date_loose, text_to_key
from martloom.functions.text import lead_minus
from martloom.plans.ingest import audit_counts
from martloom.sources.landing import FILE
from workload.common import table


def checked(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Survivors and rejects in one frame."""
    found = all_outcomes(outcomes(df, checks))
    label = F.when(F.col(REASON).isNull(), "KEPT").otherwise("REJECTED")
    return found.select(label.alias("outcome"), *df.columns, F.coalesce(REASON, F.lit("")).alias("reason"))


# --- length -------------------------------------------------------------------------

LENGTH_RULES = "p_name-VARCHAR(9)|p_brand-VARCHAR(7)"


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return checked(parts, [length_check(parse_rules(LENGTH_RULES).length, reject=True)])


def dq_length_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported but kept, with one character of tolerance."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return checked(parts, [length_check(parse_rules(LENGTH_RULES).length, reject=False, offset=1)])


_LENGTH_REASON = f"Some Columns of :'{LENGTH_RULES.replace('|', ',')}' exceeds max length".replace("'", "''")


def _length_sql(offset: int, reject: bool) -> str:
    ok = f"(length(p_name) <= {9 + offset} AND length(p_brand) <= {7 + offset})"
    kept = f"WHERE {ok}" if reject else ""
    return f"""SELECT 'KEPT' AS outcome, p_partkey, p_name, p_brand, '' AS reason FROM part {kept}
        UNION ALL SELECT 'REJECTED', p_partkey, p_name, p_brand, '{_LENGTH_REASON}' FROM part WHERE NOT {ok}"""


# --- decimals ------------------------------------------------------------------------

DIRTY_DECIMAL = """CASE (l_orderkey + l_linenumber) % 8
    WHEN 1 THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS {text}), '-')
    WHEN 2 THEN concat('  ', CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS {text}), ' ')
    WHEN 3 THEN concat('x', CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS {text}))
    WHEN 4 THEN ''
    WHEN 5 THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS {text}), '5')
    WHEN 6 THEN NULL
    WHEN 7 THEN CAST(CAST(l_quantity AS INT) AS {text})
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS {text}) END"""


def _dirty_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr("l_orderkey", "l_linenumber", f"{DIRTY_DECIMAL.format(text='STRING')} AS amount")


DECIMAL_RULE = "amount-DECIMAL(7,2)"


def dq_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(_dirty_decimals(spark, sf_dir), [decimal_check(parse_rules(DECIMAL_RULE).decimal, reject=True)])


def dq_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported, kept and rounded to one digit, unparsed text unchanged."""
    rule = parse_rules("amount-DECIMAL(38,1)").decimal
    good, _ = apply_checks(_dirty_decimals(spark, sf_dir), [decimal_check(rule)])
    return good


_DIRTY_DECIMAL_SQL = f"SELECT l_orderkey, l_linenumber, {DIRTY_DECIMAL.format(text='VARCHAR')} AS amount FROM lineitem"
_NUMBER_SQL = "CASE WHEN right(trim(amount), 1) = '-' THEN '-' || left(trim(amount), -1) ELSE trim(amount) END"
_PLAIN = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$'"


def _rounded_sql(scale: int) -> str:
    # round half away from zero on exact decimals, then to fixed-scale text
    return f"""CASE WHEN regexp_matches(num, {_PLAIN})
        THEN CAST(CAST(round(CAST(num AS DECIMAL(38,6)), {scale}) AS DECIMAL(38,{scale})) AS VARCHAR) ELSE amount END"""


DQ_DECIMAL_SQL = f"""WITH d AS ({_DIRTY_DECIMAL_SQL}), n AS (SELECT *, {_NUMBER_SQL} AS num FROM d),
    c AS (SELECT *, amount IS NULL OR amount = '' OR (regexp_matches(num, {_PLAIN})
             AND length(split_part(num, '.', 1)) <= 5 + CASE WHEN num LIKE '-%' THEN 1 ELSE 0 END) AS ok FROM n)
    SELECT 'KEPT' AS outcome, l_orderkey, l_linenumber, {_rounded_sql(2)} AS amount, '' AS reason FROM c WHERE ok
    UNION ALL SELECT 'REJECTED', l_orderkey, l_linenumber, amount,
        'Decimal columns {DECIMAL_RULE} not in proper format' FROM c WHERE NOT ok"""
DQ_ROUND_SQL = f"""WITH d AS ({_DIRTY_DECIMAL_SQL}), n AS (SELECT *, {_NUMBER_SQL} AS num FROM d)
    SELECT l_orderkey, l_linenumber, {_rounded_sql(1)} AS amount FROM n"""


# --- dates ---------------------------------------------------------------------------

DIRTY_DATE = """CASE o_orderkey % 9
    WHEN 0 THEN '0' WHEN 1 THEN '00000000' WHEN 2 THEN '' WHEN 3 THEN NULL
    WHEN 4 THEN concat(substr({key}, 1, 4), '0231')
    WHEN 5 THEN substr({key}, 1, 7)
    WHEN 6 THEN 'notadate' ELSE {key} END"""


def _dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = DIRTY_DATE.format(key="date_format(o_orderdate, 'yyyyMMdd')")
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{dirty} AS order_day")


_DIRTY_DATE_SQL = (
    "SELECT o_orderkey, " + DIRTY_DATE.format(key="strftime(o_orderdate, '%Y%m%d')") + " AS order_day FROM orders"
)
_DATE_OK = "coalesce(length(order_day) = 8 AND try_strptime(order_day, '%Y%m%d') IS NOT NULL, false)"


def _date_query(nullable: str, reject: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = parse_rules(f"order_day#DATE(yyyyMMdd,{nullable})").date
        return checked(_dirty_dates(spark, sf_dir), [date_check(rules, reject)])

    return run


def _date_sql(nullable: str) -> str:
    absent = "order_day IS NULL OR order_day IN ('', '0', '00000000') OR " if nullable == "true" else ""
    return f"""WITH d AS ({_DIRTY_DATE_SQL}), c AS (SELECT *, {absent} {_DATE_OK} AS ok FROM d)
        SELECT 'KEPT' AS outcome, o_orderkey, order_day, '' AS reason FROM c WHERE ok
        UNION ALL SELECT 'REJECTED', o_orderkey, order_day,
            'Date fields: order_day#DATE(yyyyMMdd,{nullable}) not in proper format' FROM c WHERE NOT ok"""


def _harmonise(reject: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        dirty = """CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'ddMMMyyyy')
            WHEN 1 THEN substr(date_format(o_orderdate, 'yyyyMMdd'), 1, 6) ELSE date_format(o_orderdate, 'yyyyMMdd') END"""
        days = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{dirty} AS order_day")
        return checked(days, [harmonise_check(["order_day#yyyyMMdd"], reject=reject)])

    return run


def _harmonise_sql(reject: bool) -> str:
    kept = "WHERE o_orderkey % 4 <> 1" if reject else ""
    return f"""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d%b%Y')
            WHEN 1 THEN strftime(o_orderdate, '%Y%m') ELSE strftime(o_orderdate, '%Y%m%d') END AS order_day, o_orderdate
            FROM orders)
        SELECT 'KEPT' AS outcome, o_orderkey,
               CASE WHEN o_orderkey % 4 = 1 THEN order_day ELSE strftime(o_orderdate, '%d%b%Y') END AS order_day,
               '' AS reason FROM d {kept}
        UNION ALL SELECT 'REJECTED', o_orderkey, order_day,
               'Date harmonization failed for column : order_day#yyyyMMdd' FROM d WHERE o_orderkey % 4 IN (0, 1)"""


def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded, loose and key reformatting side by side."""
    short = "concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate))"
    mixed = f"CASE WHEN o_orderkey % 3 = 0 THEN date_format(o_orderdate, 'dd/MM/yyyy') ELSE {short} END"
    days = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{mixed} AS day_text")
    return days.select(
        "o_orderkey",
        reformat_date("day_text", "dd/MM/yyyy", "yyyyMMdd").alias("guarded"),
        reformat_date_loose("day_text", "d/M/yyyy", "yyyyMMdd").alias("loose"),
        text_to_key("day_text", "dd/MM/yyyy").alias("day_key"),
    )


DATE_FUNCTIONS_SQL = """WITH d AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m%d') AS k,
        strftime(o_orderdate, '%d/%m/%Y') AS full_text,
        concat(day(o_orderdate), '/', month(o_orderdate), '/', year(o_orderdate)) AS short_text FROM orders),
    t AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN full_text ELSE short_text END AS day_text FROM d)
    SELECT o_orderkey, CASE WHEN day_text = full_text THEN k ELSE day_text END AS guarded, k AS loose,
           CASE WHEN day_text = full_text THEN k END AS day_key FROM t"""


# --- integers ------------------------------------------------------------------------

DIRTY_INTEGER = """CASE (l_orderkey + l_linenumber) % 8
    WHEN 0 THEN concat(CAST(CAST(l_quantity AS INT) AS {text}), '-')
    WHEN 1 THEN concat(' ', CAST(CAST(l_quantity AS INT) AS {text}), ' ')
    WHEN 2 THEN concat('21474836', CAST(CAST(l_quantity AS INT) + 20 AS {text}))
    WHEN 3 THEN 'ab' WHEN 4 THEN '' WHEN 5 THEN NULL
    WHEN 6 THEN concat('+', CAST(CAST(l_quantity AS INT) AS {text}))
    ELSE CAST(CAST(l_quantity AS INT) AS {text}) END"""


def _dirty_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr("l_orderkey", "l_linenumber", f"{DIRTY_INTEGER.format(text='STRING')} AS pieces")


def dq_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(_dirty_integers(spark, sf_dir), [integer_check(parse_rules("pieces-INT").integer, reject=True)])


def dq_trailing_minus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty_integers(spark, sf_dir).select("l_orderkey", "l_linenumber", lead_minus("pieces").alias("pieces"))


_DIRTY_INTEGER_SQL = f"SELECT l_orderkey, l_linenumber, {DIRTY_INTEGER.format(text='VARCHAR')} AS pieces FROM lineitem"
_MINUS_SQL = "CASE WHEN right(pieces, 1) = '-' THEN '-' || left(pieces, -1) ELSE pieces END"
DQ_INT_SQL = f"""WITH d AS ({_DIRTY_INTEGER_SQL}), n AS (SELECT *, {_MINUS_SQL} AS num FROM d),
    c AS (SELECT *, pieces IS NULL OR pieces = '' OR (regexp_matches(num, '^[+-]?[0-9]+$')
             AND CAST(CASE WHEN regexp_matches(num, '^[+-]?[0-9]+$') THEN num END AS BIGINT)
                 BETWEEN -2147483648 AND 2147483647) AS ok FROM n)
    SELECT 'KEPT' AS outcome, l_orderkey, l_linenumber, num AS pieces, '' AS reason FROM c WHERE ok
    UNION ALL SELECT 'REJECTED', l_orderkey, l_linenumber, pieces,
        'Integer fields not in proper format for column: pieces-INT' FROM c WHERE NOT ok"""
DQ_TRAILING_MINUS_SQL = f"WITH d AS ({_DIRTY_INTEGER_SQL}) SELECT l_orderkey, l_linenumber, {_MINUS_SQL} AS pieces FROM d"


# --- across rows ---------------------------------------------------------------------


def _duplicates(reject: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem").selectExpr(
            "nullif(cast(floor(l_orderkey / 2) as bigint), 3) AS order_no", "l_linenumber", "l_partkey"
        )
        return checked(lines, [duplicate_check(["order_no", "l_linenumber"], reject)])

    return run


def _duplicates_sql(reject: bool) -> str:
    kept = "WHERE n = 1" if reject else ""
    return f"""WITH d AS (SELECT nullif(CAST(floor(l_orderkey / 2) AS BIGINT), 3) AS order_no,
            l_linenumber, l_partkey FROM lineitem),
        c AS (SELECT *, count(*) OVER (PARTITION BY order_no, l_linenumber) AS n FROM d)
        SELECT 'KEPT' AS outcome, order_no, l_linenumber, l_partkey, '' AS reason FROM c {kept}
        UNION ALL SELECT 'REJECTED', order_no, l_linenumber, l_partkey,
            'Duplicate record found for combination : order_no,l_linenumber' FROM c WHERE n > 1"""


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of four segments, keyed by customer and nation."""
    customers = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return customers.select("c_custkey", "c_nationkey")


def dq_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS cust"
    )
    check = reference_check(_master(spark, sf_dir), [("cust", "c_custkey")], "customer", reject=True)
    return checked(orders, [check])


DQ_REFERENTIAL_SQL = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS cust
        FROM orders), m AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT 'KEPT' AS outcome, o_orderkey, cust, '' AS reason FROM o
    WHERE EXISTS (SELECT 1 FROM m WHERE c_custkey IS NOT DISTINCT FROM cust)
    UNION ALL SELECT 'REJECTED', o_orderkey, cust,
        'Referential Integrity failed while comparing with master customer on at least one of the following conditions cust-c_custkey'
    FROM o WHERE NOT EXISTS (SELECT 1 FROM m WHERE c_custkey IS NOT DISTINCT FROM cust)"""


def reference_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi and anti join by two null-safe keys, with multiplicity kept."""
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey % 50 AS k", "nullif(s_nationkey, 3) AS n")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey % 50 AS k", "nullif(c_nationkey, 3) AS n")
    found, lost = split_by_reference(customers, suppliers, [("k", "k"), ("n", "n")])
    return found.withColumn("side", F.lit("found")).unionByName(lost.withColumn("side", F.lit("lost")))


REFERENCE_SPLIT_SQL = """WITH s AS (SELECT DISTINCT s_suppkey % 50 AS k, nullif(s_nationkey, 3) AS n FROM supplier),
    c AS (SELECT c_custkey % 50 AS k, nullif(c_nationkey, 3) AS n FROM customer)
    SELECT c.k, c.n, CASE WHEN s.k IS NULL THEN 'lost' ELSE 'found' END AS side
    FROM c LEFT JOIN s ON c.k = s.k AND c.n IS NOT DISTINCT FROM s.n"""


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "nullif(o_orderstatus, 'P') AS status", "nullif(o_orderpriority, '5-LOW') AS priority", "o_orderkey"
    )
    return checked(orders, [not_null_check(["status", "priority"], reject=True)])


DQ_NOT_NULL_SQL = """WITH o AS (SELECT nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority,
        o_orderkey FROM orders)
    SELECT 'KEPT' AS outcome, *, '' AS reason FROM o WHERE status IS NOT NULL AND priority IS NOT NULL
    UNION ALL SELECT 'REJECTED', *, 'Null values found in columns: status,priority' FROM o
    WHERE status IS NULL OR priority IS NULL"""


# --- text and derived columns -----------------------------------------------------------


def dq_strip_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts without vowels and punctuation, as digest and length."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = remove_characters(texts, [("text", "aeiou.,;#")])
    return clean.select("doc_id", F.length("text").alias("kept_chars"), F.md5(F.col("text")).alias("digest"))


DQ_STRIP_CHARS_SQL = """WITH c AS (SELECT doc_id, translate(text, 'aeiou.,;#', '') AS t FROM documents)
    SELECT doc_id, length(t) AS kept_chars, md5(t) AS digest FROM c"""

DERIVED = ["yyyy#order_day#yyyyMMdd#yyyy", "mm#order_day#yyyyMMdd#MM", "copy#order day", "bucket#order_day#o_orderkey % 3"]


def derive_partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_columns(_dirty_dates(spark, sf_dir), DERIVED)[0]


DERIVE_SQL = f"""WITH d AS ({_DIRTY_DATE_SQL})
    SELECT o_orderkey, order_day,
        CASE WHEN {_DATE_OK} THEN substr(order_day, 1, 4) ELSE 'Unparsable' END AS yyyy,
        CASE WHEN {_DATE_OK} THEN substr(order_day, 5, 2) ELSE 'Unparsable' END AS mm,
        order_day AS "copy", o_orderkey % 3 AS bucket FROM d"""


def key_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest sighting per user and event type over a stored half and a new half."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "date_format(ts, 'yyyyMMddHHmmss') AS PROCESS_TIMESTAMP"
    )
    keys = ["user_id", "event_type"]
    stored = merge_registry(None, events.where("event_id % 2 = 0"), keys)
    merged = merge_registry(stored, events.where("event_id % 2 = 1"), keys)
    return merged.withColumnRenamed("PROCESS_TIMESTAMP", "last_seen")


KEY_REGISTRY_SQL = """SELECT user_id, event_type, max(strftime(ts, '%Y%m%d%H%M%S')) AS last_seen
    FROM events GROUP BY ALL"""


# --- the chain ---------------------------------------------------------------------------

CHAIN_RULES = "flag-VARCHAR(1)|amount-DECIMAL(7,2)|day#DATE(yyyyMMdd,true)|pieces-INT"


def _chain(spark: SparkSession, sf_dir: str, reject: bool) -> Outcomes:
    dirty = """CASE WHEN l_orderkey % 10 = 0 THEN 'bad' WHEN l_orderkey % 10 = 1 THEN '0'
        ELSE date_format(l_shipdate, 'yyyyMMdd') END"""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_no",
        "CASE WHEN l_partkey % 13 = 0 THEN concat(l_returnflag, l_linestatus) ELSE l_returnflag END AS flag",
        f"{DIRTY_DECIMAL.format(text='STRING')} AS amount",
        f"{dirty} AS day",
        f"{DIRTY_INTEGER.format(text='STRING')} AS pieces",
        f"concat('file_', l_linestatus, '.csv') AS {FILE}",
    )
    flags = dict.fromkeys(("length", "decimal", "date", "integer"), reject)
    return outcomes(lines, rule_checks(parse_rules(CHAIN_RULES), lines.columns, flags))


def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(_chain(spark, sf_dir, True)).select("order_no", "flag", "amount", "day", "pieces", F.col(REASON).alias("reason"))


def dq_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(_chain(spark, sf_dir, True)).drop(FILE)


def dq_report_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is rejected: every failing rule reports, rewrites still apply."""
    rows = rejects(_chain(spark, sf_dir, False))
    return rows.select("order_no", "flag", "amount", "day", "pieces", F.col(REASON).alias("reason"))


def dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_counts(_chain(spark, sf_dir, True)).toDF("input_file", "rows_in", "rows_rejected", "rows_out")


_CHAIN_SQL = f"""d AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_no,
        CASE WHEN l_partkey % 13 = 0 THEN concat(l_returnflag, l_linestatus) ELSE l_returnflag END AS flag,
        {DIRTY_DECIMAL.format(text='VARCHAR')} AS amount,
        CASE WHEN l_orderkey % 10 = 0 THEN 'bad' WHEN l_orderkey % 10 = 1 THEN '0'
             ELSE strftime(l_shipdate, '%Y%m%d') END AS day,
        {DIRTY_INTEGER.format(text='VARCHAR')} AS pieces, l_orderkey, concat('file_', l_linestatus, '.csv') AS input_file
        FROM lineitem),
    n AS (SELECT *, {_NUMBER_SQL} AS num, {_MINUS_SQL} AS whole FROM d),
    c AS (SELECT *, length(flag) <= 1 AS ok1,
        amount IS NULL OR amount = '' OR (regexp_matches(num, {_PLAIN})
            AND length(split_part(num, '.', 1)) <= 5 + CASE WHEN num LIKE '-%' THEN 1 ELSE 0 END) AS ok2,
        l_orderkey % 10 <> 0 AS ok3,
        pieces IS NULL OR pieces = '' OR (regexp_matches(whole, '^[+-]?[0-9]+$')
            AND CAST(CASE WHEN regexp_matches(whole, '^[+-]?[0-9]+$') THEN whole END AS BIGINT)
                BETWEEN -2147483648 AND 2147483647) AS ok4,
        {_rounded_sql(2)} AS amount2 FROM n)"""
_R1 = "'Some Columns of :''flag-VARCHAR(1)'' exceeds max length'"
_R2 = "'Decimal columns amount-DECIMAL(7,2) not in proper format'"
_R3 = "'Date fields: day#DATE(yyyyMMdd,true) not in proper format'"
_R4 = "'Integer fields not in proper format for column: pieces-INT'"


def _chain_rejects(reject: bool) -> str:
    seen = [f"ok{i}" for i in range(1, 5)]
    parts = []
    for i, (amount, reason) in enumerate((("amount", _R1), ("amount", _R2), ("amount2", _R3), ("amount2", _R4))):
        alive = "".join(f" AND {s}" for s in seen[:i]) if reject else ""
        parts.append(
            f"SELECT order_no, flag, {amount} AS amount, day, pieces, {reason} AS reason, input_file FROM c WHERE NOT ok{i + 1}{alive}"
        )
    return " UNION ALL ".join(parts)


DQ_REJECTS_SQL = f"WITH {_CHAIN_SQL} SELECT * EXCLUDE (input_file) FROM ({_chain_rejects(True)})"
DQ_REPORT_SQL = f"WITH {_CHAIN_SQL} SELECT * EXCLUDE (input_file) FROM ({_chain_rejects(False)})"
DQ_SURVIVORS_SQL = f"""WITH {_CHAIN_SQL} SELECT order_no, flag, amount2 AS amount, day, whole AS pieces FROM c
    WHERE ok1 AND ok2 AND ok3 AND ok4"""
DQ_AUDIT_SQL = f"""WITH {_CHAIN_SQL}, r AS ({_chain_rejects(True)})
    SELECT input_file, count(*) AS rows_in, (SELECT count(*) FROM r WHERE r.input_file = c.input_file) AS rows_rejected,
           count(*) FILTER (WHERE ok1 AND ok2 AND ok3 AND ok4) AS rows_out FROM c GROUP BY input_file"""


def frame_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the order lines that differ in some rows and multiplicities."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    changed = lines.where("l_orderkey % 100 <> 1").withColumn(
        "l_returnflag", F.expr("CASE WHEN l_orderkey % 50 = 0 THEN 'Z' ELSE l_returnflag END")
    )
    return frame_diff(lines, changed)


FRAME_DIFFERENCE_SQL = """WITH a AS (SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem),
    b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 50 = 0 THEN 'Z' ELSE l_returnflag END AS l_returnflag
          FROM lineitem WHERE l_orderkey % 100 <> 1),
    ca AS (SELECT *, count(*) AS n FROM a GROUP BY ALL), cb AS (SELECT *, count(*) AS n FROM b GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_returnflag, coalesce(ca.n, 0) AS left_rows, coalesce(cb.n, 0) AS right_rows
    FROM ca FULL JOIN cb USING (l_orderkey, l_linenumber, l_returnflag) WHERE coalesce(ca.n, 0) <> coalesce(cb.n, 0)"""

QUERIES = {
    "dq_length": dq_length,
    "dq_length_offset": dq_length_offset,
    "dq_decimal": dq_decimal,
    "dq_round": dq_round,
    "dq_date": _date_query("true", True),
    "dq_date_required": _date_query("false", True),
    "dq_int": dq_int,
    "dq_trailing_minus": dq_trailing_minus,
    "dq_harmonise_date": _harmonise(False),
    "dq_harmonise_reject": _harmonise(True),
    "date_functions": date_functions,
    "dq_duplicates": _duplicates(True),
    "dq_duplicates_report": _duplicates(False),
    "dq_referential": dq_referential,
    "reference_split": reference_split,
    "dq_not_null": dq_not_null,
    "dq_strip_chars": dq_strip_chars,
    "derive_partition_cols": derive_partition_cols,
    "key_registry": key_registry,
    "dq_rejects": dq_rejects,
    "dq_survivors": dq_survivors,
    "dq_report_only": dq_report_only,
    "dq_audit": dq_audit,
    "frame_diff": frame_difference,
}

ORACLE = {
    "dq_length": _length_sql(0, True),
    "dq_length_offset": _length_sql(1, False),
    "dq_decimal": DQ_DECIMAL_SQL,
    "dq_round": DQ_ROUND_SQL,
    "dq_date": _date_sql("true"),
    "dq_date_required": _date_sql("false"),
    "dq_int": DQ_INT_SQL,
    "dq_trailing_minus": DQ_TRAILING_MINUS_SQL,
    "dq_harmonise_date": _harmonise_sql(False),
    "dq_harmonise_reject": _harmonise_sql(True),
    "date_functions": DATE_FUNCTIONS_SQL,
    "dq_duplicates": _duplicates_sql(True),
    "dq_duplicates_report": _duplicates_sql(False),
    "dq_referential": DQ_REFERENTIAL_SQL,
    "reference_split": REFERENCE_SPLIT_SQL,
    "dq_not_null": DQ_NOT_NULL_SQL,
    "dq_strip_chars": DQ_STRIP_CHARS_SQL,
    "derive_partition_cols": DERIVE_SQL,
    "key_registry": KEY_REGISTRY_SQL,
    "dq_rejects": DQ_REJECTS_SQL,
    "dq_survivors": DQ_SURVIVORS_SQL,
    "dq_report_only": DQ_REPORT_SQL,
    "dq_audit": DQ_AUDIT_SQL,
    "frame_diff": FRAME_DIFFERENCE_SQL,
}
