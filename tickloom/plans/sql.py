"""SQL for the derived tables, shared by the oracle queries."""

BARS = """bars AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open,
         max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         count(*) AS volume
  FROM orders GROUP BY 1, 2)"""

BARS_EV = """bars_ev AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date, arg_min(value, event_id) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""

BARS_LI = """bars_li AS (
  SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date,
         round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS close,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2)"""

BARS_GAPPY = BARS + """, bars_gappy AS (
  SELECT ticker, date, open, high, low, CASE WHEN isodow(date) < 6 THEN close END AS close,
         CASE WHEN isodow(date) < 6 THEN volume END AS volume
  FROM bars)"""

BARS_B = BARS + """, bars_b AS (
  SELECT ticker, date, close * (1 + (day(date) - 15) / 1000.0::DOUBLE) AS close
  FROM bars WHERE isodow(date) < 6)"""

TICKS = """ticks AS (
  SELECT event_type AS ticker, ts, event_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""

SENTIMENT = """sentiment AS (
  SELECT doc_id, ['click', 'error', 'purchase', 'signup', 'view'][doc_id % 5 + 1] AS ticker,
         CAST(DATE '2024-01-01' + CAST((doc_id // 5) % 30 AS INTEGER) AS DATE) AS date,
         ((doc_id * 37) % 201 - 100) / 100.0::DOUBLE AS polarity, ((doc_id * 53) % 101) / 100.0::DOUBLE AS subjectivity,
         source
  FROM documents)"""

MACRO = """macro AS (
  SELECT l_returnflag AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         round(100 * CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS value
  FROM lineitem GROUP BY 1, 2)"""

PREDS = BARS + """, preds AS (
  SELECT ticker, date, actual, model, predicted FROM (
    SELECT ticker, date, close AS actual, 'a' AS model, lag(close) OVER w AS predicted
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)
    UNION ALL
    SELECT ticker, date, close, 'b',
           CASE WHEN count(close) OVER f = 5 THEN avg(close) OVER f END
    FROM bars WINDOW f AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
  WHERE predicted IS NOT NULL)"""

CLF = """clf AS (
  SELECT doc_id, quality AS label, 1 - toxic AS prediction, ((doc_id * 29) % 97) / 97.0::DOUBLE AS score FROM labels)"""

W = "(PARTITION BY ticker ORDER BY date)"


def frame(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, n: int) -> str:
    """``agg(x)`` over the last n rows, NULL until n values are there."""
    return f"CASE WHEN count({x}) OVER {frame(n)} >= {n} THEN {agg}({x}) OVER {frame(n)} END"


def ewm(x: str, k: str, order: str = "date") -> str:
    """The exact recursion over all rows so far; x has no NULL."""
    return (f"list_reduce(list({x}) OVER (PARTITION BY ticker ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda a, b: a * (1 - {k}) + b * {k})")


def ewm_gaps(x: str, k: str) -> str:
    """The recursion over the non-NULL values so far."""
    return (f"list_reduce(list({x}) FILTER (WHERE {x} IS NOT NULL) OVER (PARTITION BY ticker ORDER BY date "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda a, b: a * (1 - {k}) + b * {k})")
