"""SQL counterparts of the registered queries, for another engine to run."""

from __future__ import annotations

from tidemark.schemas import DERIVED_TYPES, EVENT_COLUMNS, EVENTS, Thresholds

STANDARD = Thresholds()
STRICT = Thresholds(drawdown_threshold_pct=0.98, gap_threshold_pct=40.0)
LONG = Thresholds(drawdown_window_days=2_500, drawdown_threshold_pct=0.98, gap_threshold_pct=40.0)

RUN_DATE = "DATE '2024-02-01'"

# Results of summing doubles, whose last digits depend on the order of rows.
INEXACT = {"avg_dollar_volume"}


def _bars(key: str, source: str, name: str = "bars", where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT ticker, date,
    arg_min(price, k) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, k) AS close, CAST(sum(quantity) AS BIGINT) AS volume,
    arg_max(adj, k) AS adj_close
  FROM (
    SELECT {key} AS ticker, CAST(l_shipdate AS DATE) AS date,
      l_extendedprice / l_quantity AS price, l_quantity AS quantity,
      l_extendedprice / l_quantity * (1 - l_discount) AS adj,
      struct_pack(a := l_orderkey, b := l_linenumber, c := l_extendedprice,
                  d := l_quantity, e := l_discount) AS k
    FROM lineitem JOIN {source}
  ) trades WHERE {where} GROUP BY ticker, date)"""


BARS = _bars("p_brand", "part ON l_partkey = p_partkey")
ETF_BARS = _bars("s_name", "supplier ON l_suppkey = s_suppkey")


def _columns(event_type: str, common_layout: bool) -> str:
    """The select list of an event type, doubles rounded, dates as stamped."""
    own = EVENT_COLUMNS[event_type]
    names = EVENTS.names if common_layout else own
    sql_types = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    out = []
    for name in names:
        sql_type = sql_types[EVENTS[name].dataType.simpleString()]
        if name not in own:
            out.append(f"CAST(NULL AS {sql_type}) AS {name}")
        elif name in INEXACT:
            out.append(f"round({name}, 6) AS {name}")
        else:
            out.append(f"CAST({name} AS {sql_type}) AS {name}")
    return ", ".join(out)


def _stamp(event_type: str, source: str) -> str:
    return f"'{event_type}' AS event_type, '{source}' AS source, {RUN_DATE} AS created_at"


DERIVED = "derived from local prices"


def _marked(t: Thresholds) -> dict[str, str]:
    """Per derived type, a subquery over bars that yields its events."""
    days, spike_days = t.drawdown_window_days, t.volume_spike_window_days
    return {
        "drawdowns": f"""
  SELECT ticker, date, {_stamp("drawdowns", DERIVED)}, {days} AS window_days,
    {t.drawdown_threshold_pct} AS threshold_pct, adj_close / peak - 1 AS drawdown_pct, peak_date
  FROM (SELECT *, max(adj_close) OVER w AS peak,
      arg_max(date, struct_pack(p := adj_close, e := -rn)) OVER w AS peak_date
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM bars) n
    WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW)) m
  WHERE adj_close / peak - 1 <= CAST(-{t.drawdown_threshold_pct} AS DOUBLE)""",
        "gaps": f"""
  SELECT ticker, date, {_stamp("gaps", DERIVED)}, {t.gap_threshold_pct} AS threshold_pct,
    open / prior_close - 1 AS gap_pct, prior_close, open
  FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prior_close FROM bars) m
  WHERE abs(open / prior_close - 1) >= CAST({t.gap_threshold_pct} AS DOUBLE)""",
        "volume_spikes": f"""
  SELECT ticker, date, {_stamp("volume_spikes", DERIVED)}, {spike_days} AS window_days,
    {t.volume_spike_zscore} AS zscore_threshold,
    (volume - trailing_mean) / trailing_std AS volume_zscore, volume, trailing_mean, trailing_std
  FROM (SELECT *, CAST(s AS DOUBLE) / {spike_days} AS trailing_mean,
      sqrt(CAST({spike_days} * q - s * s AS DOUBLE) / {spike_days * (spike_days - 1)}) AS trailing_std
    FROM (SELECT *, sum(CAST(volume AS HUGEINT)) OVER w AS s, sum(CAST(volume AS HUGEINT) * volume) OVER w AS q,
        count(volume) OVER w AS n
      FROM bars
      WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {spike_days} PRECEDING AND 1 PRECEDING)) sums) m
  WHERE n = {spike_days} AND trailing_std > 0
    AND (volume - trailing_mean) / trailing_std >= CAST({t.volume_spike_zscore} AS DOUBLE)""",
    }


def _detector(event_type: str, t: Thresholds) -> str:
    return f"WITH {BARS} SELECT {_columns(event_type, False)} FROM ({_marked(t)[event_type]}) e"


def _derived(t: Thresholds) -> str:
    marked = _marked(t)
    return " UNION ALL ".join(
        f"SELECT {_columns(name, True)} FROM ({marked[name]}) {name}" for name in DERIVED_TYPES
    )


EARNINGS = f"""
  SELECT {_stamp("earnings", "yfinance earnings dates")}, ticker, date, event_time FROM (
    SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts + INTERVAL 5 HOUR AS DATE) AS date,
      CASE WHEN value >= 50 THEN 'amc' ELSE 'bmo' END AS event_time,
      row_number() OVER (PARTITION BY user_id, CAST(ts + INTERVAL 5 HOUR AS DATE)
                         ORDER BY event_id DESC) AS rn
    FROM events WHERE event_type = 'signup') r
  WHERE rn = 1"""

LATER_EARNINGS = EARNINGS.replace(
    "event_type = 'signup'", "event_type = 'signup' AND (user_id % 3 <> 0 OR event_id % 4 <> 0)"
)

HASHED = {
    "orders": "o_custkey o_orderdate o_orderkey O_ORDERPRIORITY O_ORDERSTATUS o_totalprice",
    "lineitem": "l_discount l_extendedprice l_linenumber L_LINESTATUS l_orderkey l_partkey l_quantity L_RETURNFLAG "
    "l_shipdate l_suppkey l_tax",
    "events": "event_id EVENT_TYPE PROPS ts user_id value",
}


def _fingerprint(table: str, columns: str) -> str:
    """Rows and summed leading bits of the MD5 of each row's text; names in capitals are texts."""
    texts = ", ".join(
        f"coalesce(length({c}) || ':' || {c}, 'null')" if c.isupper() else f"coalesce(CAST({c} AS VARCHAR), 'null')"
        for c in columns.split()
    )
    bits = f"CAST('0x' || substr(md5(concat_ws(',', {texts})), 1, 15) AS BIGINT)"
    return f"""SELECT '{table}' AS "table", count(*) AS n_rows,
      CAST(CAST(sum(CAST({bits} AS HUGEINT)) AS HUGEINT) AS VARCHAR) AS content_hash FROM {table}"""


ALL_EVENTS = f"SELECT {_columns('earnings', True)} FROM ({EARNINGS}) earnings UNION ALL {_derived(STANDARD)}"


REQUEST = """
request AS (
  SELECT ticker, min(position) AS position FROM (
    SELECT p_partkey AS position, p_brand AS ticker FROM part
    UNION ALL SELECT p_partkey, p_type FROM part) names
  GROUP BY ticker)"""
BRANDS = """
brands AS (SELECT p_brand AS ticker, min(p_partkey) AS position FROM part GROUP BY p_brand)"""

# The price ingest: stored up to the cut-off, delivered from ten days before.
INGEST = f"""{BARS}, {REQUEST},
last AS (SELECT ticker, max(date) AS last_date FROM bars
  WHERE date < DATE '1999-01-01' AND ticker <> 'Brand#7' GROUP BY ticker),
fetched AS (SELECT r.ticker, last_date, coalesce(last_date + 1, DATE '1999-01-01') AS fetch_from
  FROM request r LEFT JOIN last l ON r.ticker = l.ticker),
increment AS (SELECT b.* FROM bars b JOIN fetched f ON b.ticker = f.ticker
  WHERE b.date BETWEEN f.fetch_from AND DATE '2024-02-01' AND b.date >= DATE '1998-12-22'),
status AS (SELECT 'prices' AS dataset, f.ticker,
    CASE WHEN f.ticker IN (SELECT ticker FROM increment) THEN 'updated'
         WHEN last_date >= DATE '2024-02-01' THEN 'already_current'
         WHEN last_date IS NOT NULL THEN 'no_new_bars' ELSE 'skipped' END AS status
  FROM fetched f)"""

INFO = """
info AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) r
  WHERE rn = 1)"""

SECTORS = f"""WITH {INFO} SELECT CAST(user_id AS VARCHAR) AS ticker,
  CASE WHEN k % 3 <> 0 THEN event_type END AS sector,
  CASE WHEN k % 4 <> 0 THEN 'Industry ' || k END AS industry,
  CASE WHEN k % 2 = 0 THEN 'ETF' ELSE 'EQUITY' END AS quote_type,
  'yfinance .info' AS source, {RUN_DATE} AS retrieved_at FROM info"""

HELD = """
cents AS (SELECT c_nationkey, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents
  FROM customer GROUP BY c_nationkey),
held AS (SELECT r_name AS etf, n_nationkey AS position, n_name AS ticker, cents,
    sum(cents) OVER (PARTITION BY r_name) AS total
  FROM cents JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

RECORDS = r"""
records AS (SELECT p_partkey, lower(substr(p_type, 1, 4)) || '.' || p_size AS raw_ticker,
    upper(replace(lower(substr(p_type, 1, 4)) || '.' || p_size, '.', '-')) AS ticker,
    p_name AS name, p_brand AS sector, p_retailprice AS weight_pct
  FROM part WHERE p_partkey % 4 <> 0),
checked AS (SELECT *, regexp_matches(ticker, '^[A-Z0-9][A-Z0-9\-]{0,5}$') AS valid FROM records)"""


def _clean(name: str) -> str:
    return f"""WITH {RECORDS} SELECT ticker, {name} AS name, sector, weight_pct,
      'iShares IVV holdings' AS source, {RUN_DATE} AS retrieved_at FROM checked WHERE valid"""


def _ranked(lookback_days: int) -> str:
    return f"""{ETF_BARS},
means AS (SELECT ticker, avg(close * volume) AS avg_dollar_volume FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS age FROM bars
    WHERE date > DATE '2001-11-04' - {lookback_days} AND date <= DATE '2001-11-04') recent
  WHERE age <= 30 GROUP BY ticker),
ranked AS (SELECT ticker, round(avg_dollar_volume, 6) AS avg_dollar_volume, CAST(row_number() OVER (
    ORDER BY avg_dollar_volume DESC, ticker) AS INTEGER) AS rank FROM means)"""


METADATA = f"""WITH {INFO} SELECT CAST(c_custkey AS VARCHAR) AS ticker,
        CASE WHEN k % 5 <> 0 THEN 'Long ' || k WHEN k % 7 <> 0 THEN 'Short ' || k ELSE c_name END AS name,
        c_mktsegment AS category,
        CASE WHEN k <> 0 THEN DATE '1970-01-01' + CAST(k AS INTEGER)
          WHEN event_id <> 0 THEN DATE '1970-01-01' + CAST(event_id // 86400 AS INTEGER) END AS inception_date,
        'yfinance .info' AS source, {RUN_DATE} AS retrieved_at
      FROM customer LEFT JOIN info ON c_custkey = user_id"""


ORACLES: dict[str, str] = {
    "drawdowns": _detector("drawdowns", STANDARD),
    "drawdowns_strict": _detector("drawdowns", STRICT),
    "gaps": _detector("gaps", STANDARD),
    "gaps_strict": _detector("gaps", STRICT),
    "volume_spikes": _detector("volume_spikes", STANDARD),
    "derived_events": f"WITH {BARS} {_derived(STRICT)}",
    "derived_events_split": f"WITH {BARS} {_derived(STRICT)}",
    "drawdowns_long_window": _detector("drawdowns", LONG),
    "derived_events_long_window": f"WITH {BARS} {_derived(LONG)}",
    "events_all": f"WITH {BARS} {ALL_EVENTS}",
    "events_filtered": f"""WITH {BARS} SELECT * FROM ({ALL_EVENTS}) e
      WHERE ticker IN ('Brand#3', 'Brand#12', '17')
        AND date BETWEEN DATE '1996-03-01' AND DATE '2024-02-01'""",
    "load_prices_adjusted": f"""WITH {BARS}, {BRANDS}
      SELECT position, b.ticker, date, open * r AS open, high * r AS high,
        low * r AS low, close * r AS close, volume, adj_close
      FROM (SELECT *, coalesce(adj_close / nullif(close, 0), 1.0) AS r FROM bars) b
        JOIN brands ON b.ticker = brands.ticker""",
    "load_prices_raw": f"""WITH {BARS}, {BRANDS}
      SELECT position, b.* FROM bars b JOIN brands ON b.ticker = brands.ticker
      WHERE date BETWEEN DATE '1996-03-01' AND DATE '1998-02-28'""",
    "missing_tickers": f"""WITH {BARS}, {REQUEST} SELECT position, ticker FROM request r
      WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.ticker = r.ticker AND date = DATE '1996-03-01')""",
    "price_increment": f"""WITH {INGEST} SELECT ticker, date, open, high, low,
      close * CAST(1.01 AS DOUBLE) AS close, volume, adj_close FROM increment""",
    "price_status": f"""WITH {INGEST} SELECT dataset, ticker, status,
      CASE WHEN status = 'skipped' THEN 'no bars delivered in range' END AS reason FROM status""",
    "run_summary": f"""WITH {INGEST} SELECT dataset, status, count(*) AS tickers FROM status
      GROUP BY dataset, status""",
    "updated_tickers": f"WITH {INGEST} SELECT ticker FROM status WHERE status = 'updated'",
    "last_dates": f"""WITH {BARS} SELECT ticker, max(date) AS last_date, count(*) AS bars
      FROM bars GROUP BY ticker""",
    "wide_to_long_prices": f"WITH {BARS} SELECT * FROM bars",
    "merge_snapshot": """
      WITH existing AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 0 AS is_new
          FROM orders WHERE o_orderkey % 2 = 0
            AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')),
        new AS (SELECT o_orderkey, o_custkey, o_totalprice * 2, o_orderpriority, 1
          FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 10 = 0)
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY is_new DESC) AS rn
        FROM (SELECT * FROM existing UNION ALL SELECT * FROM new) both_sides) r
      WHERE rn = 1""",
    "missing_from_snapshot": """
      SELECT c_custkey AS position, c_custkey AS ticker FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "snapshot_changed": """
      WITH old AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
        new AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT'
          THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders)
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
        CAST(sum(copy) AS BIGINT) AS copies FROM (
          SELECT *, -1 AS copy FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) gone
          UNION ALL SELECT *, 1 FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old) added) d
      GROUP BY o_orderkey, o_custkey, o_totalprice, o_orderpriority""",
    "unique_ordered": f"WITH {BRANDS} SELECT position, ticker FROM brands",
    "sectors_from_info": SECTORS,
    "store_sectors": SECTORS,
    "store_events": f"WITH {BARS} {_derived(STRICT)}",
    "store_prices": f"""WITH {INGEST},
      kept AS (SELECT * FROM bars WHERE date < DATE '1999-01-01' AND ticker <> 'Brand#7'
        UNION ALL SELECT * REPLACE (close * CAST(1.01 AS DOUBLE) AS close) FROM increment)
      SELECT position, kept.* FROM kept JOIN request r ON kept.ticker = r.ticker""",
    "store_prices_forced": f"""WITH {BARS}, {BRANDS},
      kept AS (SELECT * FROM bars WHERE ticker NOT LIKE 'Brand#1%'
        UNION ALL SELECT * REPLACE (close * CAST(1.01 AS DOUBLE) AS close) FROM bars
          WHERE ticker LIKE 'Brand#1%' AND date >= DATE '1998-12-22')
      SELECT position, kept.* FROM kept JOIN brands ON kept.ticker = brands.ticker""",
    "store_prices_wide": f"""WITH {BARS}, {BRANDS}
      SELECT position, b.* FROM bars b JOIN brands ON b.ticker = brands.ticker""",
    "store_prices_order": f"""WITH {BARS} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order,
        CAST(0 AS BIGINT) AS n_overlapping_files FROM bars""",
    "price_status_current": f"""WITH {BARS}, {REQUEST},
      last AS (SELECT ticker, max(date) AS last_date FROM bars
        WHERE date < DATE '1999-01-01' AND ticker <> 'Brand#7' GROUP BY ticker)
      SELECT 'prices' AS dataset, r.ticker,
        CASE WHEN last_date >= DATE '1998-12-30' THEN 'already_current'
          WHEN last_date IS NOT NULL THEN 'no_new_bars' ELSE 'skipped' END AS status,
        CASE WHEN last_date IS NULL THEN 'no bars delivered in range' END AS reason
      FROM request r LEFT JOIN last l ON r.ticker = l.ticker""",
    "manifest_hashes": """
      SELECT 'region=' || n_regionkey AS folder, CAST(sum(strlen(line)) AS BIGINT) AS size_bytes,
        sha256(string_agg(line, '' ORDER BY n_nationkey)) AS sha256
      FROM (SELECT *, n_nationkey || ',' || n_name || chr(10) AS line FROM nation) l GROUP BY n_regionkey""",
    "metadata_from_info": METADATA,
    "holdings_normalized": f"""WITH {HELD} SELECT etf, CAST(position AS BIGINT) AS position, ticker,
        'Holding of ' || ticker AS name,
        CAST(cents AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS weight_pct,
        'yfinance funds_data.top_holdings' AS source, {RUN_DATE} AS retrieved_at FROM held""",
    "constituents": f"""WITH {HELD} SELECT CAST(position AS BIGINT) AS position, ticker FROM held
      WHERE etf = 'ASIA' ORDER BY position""",
    "earnings_normalized": f"SELECT {_columns('earnings', False)} FROM ({EARNINGS}) e",
    "ticker_clean": _clean("name"),
    "ticker_rejects": f"WITH {RECORDS} SELECT p_partkey, raw_ticker, ticker FROM checked WHERE NOT valid",
    "universe_all": """
      SELECT CAST(0 AS INTEGER) AS part, s_suppkey AS position, s_name AS ticker FROM supplier
      UNION ALL SELECT CAST(1 AS INTEGER), c_custkey, c_name FROM customer""",
    "etf_rank_top50": f"""WITH {_ranked(4000)} SELECT ticker, avg_dollar_volume, rank
      FROM ranked WHERE rank <= 50""",
    "etf_enriched": f"""WITH {_ranked(90)} SELECT ticker, 'Fund ' || s_suppkey AS name,
        n_name AS category, avg_dollar_volume, rank, 'yfinance 30d avg dollar volume' AS source,
        DATE '2001-11-04' AS retrieved_at
      FROM ranked JOIN supplier ON ticker = s_name JOIN nation ON s_nationkey = n_nationkey
      WHERE rank <= 50""",
    "store_events_many": f"""WITH {BARS} SELECT * REPLACE (
        DATE '2024-01-01' + CAST(greatest(year(date) - 1992, 0) AS INTEGER) AS created_at)
      FROM ({_derived(STRICT)}) e""",
    "store_holdings": f"""WITH {HELD} SELECT etf, CAST(position AS BIGINT) AS position, ticker,
        CASE WHEN etf < 'ASIB' THEN 'New ' ELSE '' END || 'Holding of ' || ticker AS name,
        CAST(cents AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS weight_pct,
        'yfinance funds_data.top_holdings' AS source, {RUN_DATE} AS retrieved_at
      FROM held WHERE etf >= 'ASIB' OR position % 2 = 0""",
    "store_earnings": f"SELECT {_columns('earnings', False)} FROM ({LATER_EARNINGS}) e",
    "store_universe": f"""WITH {RECORDS}, {_ranked(90)} SELECT ticker FROM checked WHERE valid
      UNION ALL SELECT ticker FROM ranked WHERE rank <= 50""",
    "store_metadata": METADATA,
    "store_all": f"""WITH {BARS}, {BRANDS},
      users AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker FROM events),
      earning AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker FROM events WHERE event_type = 'signup'),
      asked AS (SELECT ticker FROM brands UNION SELECT ticker FROM users),
      listed AS (SELECT ticker FROM brands WHERE ticker LIKE 'Brand#1%'
        UNION SELECT ticker FROM users WHERE CAST(ticker AS BIGINT) % 5 = 0),
      holding AS (SELECT ticker FROM users WHERE CAST(ticker AS BIGINT) % 10 = 0),
      found AS ({_derived(STRICT)})
      SELECT 'prices' AS dataset, ticker, CASE WHEN ticker IN (SELECT ticker FROM bars) THEN 'updated' ELSE 'skipped' END AS status,
        CASE WHEN ticker NOT IN (SELECT ticker FROM bars) THEN 'no bars delivered in range' END AS reason FROM asked
      UNION ALL SELECT 'sectors', ticker, CASE WHEN ticker IN (SELECT ticker FROM users) THEN 'updated' ELSE 'skipped' END,
        CASE WHEN ticker NOT IN (SELECT ticker FROM users) THEN 'no info delivered' END FROM asked
      UNION ALL SELECT 'etf_metadata', ticker, CASE WHEN ticker IN (SELECT ticker FROM users) THEN 'updated' ELSE 'skipped' END,
        CASE WHEN ticker NOT IN (SELECT ticker FROM users) THEN 'no info delivered' END FROM listed
      UNION ALL SELECT 'etf_holdings', ticker, CASE WHEN ticker IN (SELECT ticker FROM holding) THEN 'updated' ELSE 'skipped' END,
        CASE WHEN ticker NOT IN (SELECT ticker FROM holding) THEN 'no holdings delivered' END FROM listed
      UNION ALL SELECT 'earnings', ticker, CASE WHEN ticker IN (SELECT ticker FROM earning) THEN 'updated' ELSE 'skipped' END,
        CASE WHEN ticker NOT IN (SELECT ticker FROM earning) THEN 'no readable earnings dates delivered' END FROM asked
      UNION ALL SELECT type, NULL, CASE WHEN type IN (SELECT event_type FROM found) THEN 'updated' ELSE 'already_current' END, NULL
        FROM (VALUES {", ".join(f"('{t}')" for t in DERIVED_TYPES)}) AS types(type)
      UNION ALL SELECT 'derived_events', ticker, 'skipped', 'no bars stored' FROM asked
        WHERE ticker NOT IN (SELECT ticker FROM bars)""",
    "price_rejects": """
      WITH raw AS (SELECT event_id AS position, CASE WHEN event_id % 17 <> 0 THEN event_type END AS ticker,
          CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN '2024-13-01' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day,
          CASE event_id % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS price,
          CASE WHEN event_id % 11 <> 0 THEN 7 END AS volume FROM events),
        read AS (SELECT position, ticker, TRY_CAST(day AS DATE) AS date, TRY_CAST(price AS DOUBLE) AS close,
          CAST(volume AS BIGINT) AS volume, day, price FROM raw),
        judged AS (SELECT *, CASE WHEN date IS NULL THEN 'unreadable Date'
            WHEN price IS NOT NULL AND close IS NULL THEN 'unreadable Close'
            WHEN ticker IS NULL THEN 'no ticker' WHEN close IS NULL THEN 'no close'
            WHEN volume IS NULL THEN 'no volume' END AS reason FROM read)
      SELECT position, ticker, date, close, volume, reason FROM judged WHERE reason IS NOT NULL""",
    "document_hashes": "SELECT doc_id, strlen(text) AS size_bytes, sha256(text) AS sha256 FROM documents",
    "content_fingerprint": " UNION ALL ".join(_fingerprint(name, columns) for name, columns in HASHED.items()),
    "dirty_csv_holdings": _clean("name || ', \"x\"'"),
}
