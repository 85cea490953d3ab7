"""The same results as plain SQL over the driver's tables.

Each statement is built from named steps. Gap filling joins a time spine and strategies run over whole series here, so
the SQL is independent of how the Spark operators split their work.
"""

from __future__ import annotations

from registry.queries import AS_OF, WINDOW_END, WINDOW_START
from registry.tables import BY_TYPE, BY_USER, RULES

KEY = 'exchange, symbol, "interval"'
PK = f"{KEY}, open_time"
SERIES_ORDER = f"PARTITION BY {KEY} ORDER BY open_time"
SILVER = (
    f"{PK}, close_time, open, high, low, close, volume, quote_volume, trade_count, taker_buy_base_volume, "
    "taker_buy_quote_volume, is_synthetic, load_source, ingested_at"
)
FEATURES = "return_1, return_5, return_20, log_return_1, ma_5, ma_20, ma_50, vol_5, vol_20"
FLOATS = (
    "open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume",
    *FEATURES.split(", "),
)
DIGITS = {"quote_volume": 4, "taker_buy_quote_volume": 4}

START, END = (f"TIMESTAMP '{x[:19].replace('T', ' ')}'" for x in (WINDOW_START, WINDOW_END))
NOW = f"TIMESTAMP '{AS_OF[:19].replace('T', ' ')}'"


def rounded(columns: str) -> str:
    """A select list with every double rounded as the queries round theirs."""
    out = []
    for name in (c.strip() for c in columns.split(",")):
        out.append(f"round({name}, {DIGITS.get(name, 6)}) AS {name}" if name in FLOATS else name)
    return ", ".join(out)


def symbol(by: str) -> str:
    return "event_type" if by == BY_TYPE else "'u' || CAST(user_id AS VARCHAR)"


def ticks(by: str = BY_TYPE) -> str:
    return f"""ticks AS (
  SELECT 'synthetic' AS exchange, {symbol(by)} AS symbol, ts AS event_time, 100.0::DOUBLE + value / 10 AS price,
         'events' AS source, ts AS ingested_at, event_id
  FROM events)"""


def bars(by: str = BY_TYPE, code: str = "1h", minutes: int = 60) -> str:
    return ticks(by) + "," + bar_rows("bars", code, minutes)


def bar_rows(name: str, code: str, minutes: int) -> str:
    start = f"time_bucket(INTERVAL {minutes} MINUTE, event_time)"
    return f"""
{name} AS (
  SELECT exchange, symbol, '{code}' AS "interval", {start} AS open_time,
         {start} + INTERVAL {minutes} MINUTE - INTERVAL 1 MILLISECOND AS close_time,
         arg_min(price, event_time) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, event_time) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(price) AS quote_volume,
         count(*) AS trade_count,
         CAST(sum(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS taker_buy_base_volume,
         sum(CASE WHEN event_id % 2 = 0 THEN price ELSE 0.0 END) AS taker_buy_quote_volume,
         FALSE AS is_synthetic, 'events' AS load_source, max(event_time) AS ingested_at
  FROM ticks GROUP BY ALL)"""


def raw(by: str = BY_TYPE) -> str:
    """Landed bars after typing: unreadable volumes are NULL, stale revisions are extra rows."""
    return bars(by) + """,
typed AS (
  SELECT * REPLACE (CASE WHEN trade_count % 7 = 0 THEN NULL ELSE volume END AS volume) FROM bars
  UNION ALL
  SELECT * REPLACE (CASE WHEN trade_count % 7 = 0 THEN NULL ELSE volume END AS volume, close + 1 AS close,
                    ingested_at - INTERVAL 1 MINUTE AS ingested_at)
  FROM bars WHERE trade_count % 3 = 0)"""


def dedup(source: str = "typed", name: str = "latest") -> str:
    return f""",
{name} AS (
  SELECT {SILVER} FROM {source}
  QUALIFY row_number() OVER (PARTITION BY {PK} ORDER BY ingested_at DESC NULLS FIRST) = 1)"""


def fill(source: str, name: str = "silver", minutes: int = 60) -> str:
    """Reindex to a spine of bars from the first to the last bar of each series."""
    zero = ("volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")
    picks = ", ".join(
        f"CASE WHEN synthetic THEN known_close ELSE {c} END AS {c}" for c in ("open", "high", "low", "close")
    )
    zeros = ", ".join(f"CASE WHEN synthetic THEN 0 ELSE {c} END AS {c}" for c in zero)
    return f""",
{name}_spine AS (
  SELECT {KEY}, unnest(generate_series(first_bar, last_bar, INTERVAL {minutes} MINUTE)) AS open_time
  FROM (SELECT {KEY}, min(open_time) AS first_bar, max(open_time) AS last_bar FROM {source} GROUP BY ALL)),
{name}_joined AS (
  SELECT {", ".join(f"s.{c.strip()}" for c in PK.split(","))}, b.* EXCLUDE ({PK}), b.load_source IS NULL AS synthetic
  FROM {name}_spine s LEFT JOIN {source} b USING ({PK})),
{name}_known AS (
  SELECT *, last_value(close IGNORE NULLS) OVER w AS known_close,
         last_value(load_source IGNORE NULLS) OVER w AS known_source,
         last_value(ingested_at IGNORE NULLS) OVER w AS known_ingested
  FROM {name}_joined WINDOW w AS ({SERIES_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name} AS (
  SELECT {PK}, CASE WHEN synthetic THEN open_time + INTERVAL {minutes} MINUTE - INTERVAL 1 MILLISECOND ELSE close_time END
           AS close_time,
         {picks}, {zeros}, synthetic AS is_synthetic, known_source AS load_source, known_ingested AS ingested_at
  FROM {name}_known)"""


def features(source: str, name: str = "gold") -> str:
    def frame(n: int) -> str:
        return f"OVER ({SERIES_ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    changes = ", ".join(
        f"close / nullif(lag(close, {n}) OVER ({SERIES_ORDER}), 0) - 1 AS return_{n}" for n in (1, 5, 20)
    )
    means = ", ".join(
        f"CASE WHEN count(close) {frame(n)} = {n} THEN avg(close) {frame(n)} END AS ma_{n}" for n in (5, 20, 50)
    )
    deviations = ", ".join(
        f"CASE WHEN count(return_1) {frame(n)} = {n} THEN stddev_pop(return_1) {frame(n)} END AS vol_{n}"
        for n in (5, 20)
    )
    return f""",
{name}_changes AS (
  SELECT *, {changes}, ln(close) - lag(ln(close)) OVER ({SERIES_ORDER}) AS log_return_1, {means} FROM {source}),
{name} AS (SELECT {SILVER}, return_1, return_5, return_20, log_return_1, ma_5, ma_20, ma_50, {deviations}
           FROM {name}_changes)"""


def silver(by: str = BY_TYPE) -> str:
    return raw(by) + dedup() + fill("latest")


def select(steps: str, body: str) -> str:
    return f"WITH {steps}\n{body}"


def rule_rows(by: str = BY_TYPE, with_bad: bool = False) -> str:
    """Valid rules of every symbol."""
    rows = [(f"symbol || '_{d}'", "NULL", d, v) for d, v in RULES]
    rows += [("symbol || '_spot'", "'spot'", "cross_above", 108.0), ("symbol || '_hourly'", "'1h'", "cross_above", 107.0)]
    unions = "\n  UNION ALL ".join(
        f"SELECT symbol, CAST({interval} AS VARCHAR) AS \"interval\", '{direction}' AS direction, "
        f"CAST({value} AS DOUBLE) AS threshold, {name} AS signal_name FROM symbols"
        for name, interval, direction, value in rows
    )
    return f"""symbols AS (SELECT DISTINCT {symbol(by)} AS symbol FROM events),
rules AS (
  {unions})"""


LADDER = """rules AS (
  SELECT event_type AS symbol, CAST(NULL AS VARCHAR) AS "interval", direction, round(100.0::DOUBLE + value / 10 + step, 3) AS threshold,
         direction || '_' || CAST(step AS INTEGER) || '_' || event_id AS signal_name
  FROM events, (VALUES ('above'), ('below'), ('cross_above'), ('cross_below')) d(direction), (VALUES (30.0::DOUBLE), (35.0), (40.0)) s(step))"""


def alert_rows(source: str, label: str) -> str:
    """Ticks with their predecessor, joined with the rules they fire."""
    return f""",
changes AS (
  SELECT *, lag(price) OVER (PARTITION BY exchange, symbol ORDER BY event_time) AS previous FROM {source}),
events_out AS (
  SELECT r.signal_name, c.exchange, c.symbol, '{label}' AS "interval", c.event_time, round(c.price, 6) AS observed_value,
         r.threshold, r.direction, c.source
  FROM changes c JOIN rules r ON c.symbol = r.symbol AND (r."interval" IS NULL OR r."interval" = '{label}')
  WHERE CASE r.direction
    WHEN 'above' THEN c.price >= r.threshold AND NOT coalesce(c.previous >= r.threshold, FALSE)
    WHEN 'below' THEN c.price <= r.threshold AND NOT coalesce(c.previous <= r.threshold, FALSE)
    WHEN 'cross_above' THEN c.previous < r.threshold AND c.price >= r.threshold
    ELSE c.previous > r.threshold AND c.price <= r.threshold END)"""


CROSS_ONLY = "('cross', 'cross_above', 106.0, 'cross_below', 103.0, 100000.0, 5.0)"
VARIANTS = f"""{CROSS_ONLY},
  ('level', 'above', 104.0, 'below', 101.5, 50000.0, 10.0),
  ('toggle', 'above', 102.0, 'above', 104.0, 100000.0, 200.0)"""


def strategy(source: str, variants: str = VARIANTS) -> str:
    order = f"PARTITION BY {KEY}, strategy_id ORDER BY open_time"
    running = f"OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def trigger(side: str) -> str:
        d, v = f"{side}_direction", f"{side}_threshold"
        return f"""coalesce(CASE {d} WHEN 'above' THEN close >= {v} WHEN 'below' THEN close <= {v}
      WHEN 'cross_above' THEN previous < {v} AND close >= {v} ELSE previous > {v} AND close <= {v} END, FALSE)"""

    return f""",
variants(strategy_id, entry_direction, entry_threshold, exit_direction, exit_threshold, capital, bps) AS (VALUES
  {variants}),
paired AS (SELECT *, lag(close) OVER ({SERIES_ORDER}) AS previous FROM {source}),
fired AS (
  SELECT *, coalesce(close / nullif(previous, 0) - 1, 0) AS asset_return,
         {trigger("entry")} AS enter, {trigger("exit")} AS leave
  FROM paired CROSS JOIN variants),
grouped AS (
  SELECT *, coalesce(last_value(CASE WHEN enter <> leave THEN CAST(enter AS INT) END IGNORE NULLS) {running}, 0) AS base,
         sum(CASE WHEN enter <> leave THEN 1 ELSE 0 END) {running} AS segment FROM fired),
targets AS (
  SELECT *, CAST((base + sum(CASE WHEN enter AND leave THEN 1 ELSE 0 END) OVER (
    PARTITION BY {KEY}, strategy_id, segment ORDER BY open_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    % 2 AS DOUBLE) AS target_position FROM grouped),
held AS (
  SELECT *, coalesce(lag(target_position) OVER ({order}), 0) AS position,
         coalesce(abs(target_position - lag(target_position) OVER ({order})), target_position) AS turnover
  FROM targets),
earned AS (
  SELECT *, turnover * (bps / 10000.0) AS transaction_cost,
         position * asset_return - turnover * (bps / 10000.0) AS strategy_return FROM held),
curves AS (SELECT *, capital * product(1 + strategy_return) {running} AS equity_curve FROM earned),
results AS (SELECT *, equity_curve / max(equity_curve) {running} - 1 AS drawdown FROM curves),
metrics AS (
  SELECT {KEY}, strategy_id, count(*) AS bar_count, arg_max(equity_curve / capital, open_time) AS ratio,
         avg(strategy_return) AS mean, stddev_pop(strategy_return) AS deviation, min(drawdown) AS max_drawdown,
         count(*) FILTER (WHERE turnover > 0) AS trade_count
  FROM results GROUP BY ALL),
performance AS (
  SELECT {KEY}, strategy_id, bar_count, round(ratio - 1, 6) AS total_return,
         round(pow(ratio, 8760.0 / bar_count) - 1, 6) AS annualized_return,
         round(deviation * sqrt(8760.0), 6) AS annualized_volatility,
         round(CASE WHEN deviation = 0 THEN 0 ELSE mean / deviation * sqrt(8760.0) END, 6) AS sharpe_ratio,
         round(max_drawdown, 6) AS max_drawdown, trade_count
  FROM metrics)"""


def results(columns: str, by: str = BY_TYPE) -> str:
    return select(silver(by) + strategy("silver"), f"SELECT {PK}, strategy_id, {columns} FROM results")


def quality(source: str, bar_ms: str = "3600000") -> str:
    return f"""SELECT *, CASE WHEN reason IS NULL THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT *, CASE WHEN row_count <> distinct_pk THEN 'duplicate primary key'
                 WHEN gap_violations > 0 THEN 'missing bars' END AS reason
  FROM (SELECT *, greatest((epoch_ms(max_open_time) - epoch_ms(min_open_time)) // ({bar_ms}) + 1 - row_count, 0)
                  AS gap_violations
        FROM (SELECT {KEY}, count(*) AS row_count, count(DISTINCT open_time) AS distinct_pk,
                     min(open_time) AS min_open_time, max(open_time) AS max_open_time
              FROM {source} GROUP BY ALL)))"""


def all_intervals() -> str:
    """The report over bars of every interval."""
    # Interval codes and their minutes.
    codes = {"1m": 1, "3m": 3, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "2h": 120, "4h": 240, "6h": 360, "8h": 480, "12h": 720, "1d": 1440}
    parts = [bar_rows(f"bars{i}", code, minutes) for i, (code, minutes) in enumerate(codes.items())]
    union = " UNION ALL ".join(f"SELECT * FROM bars{i}" for i in range(len(codes)))
    length = "CASE \"interval\" " + " ".join(f"WHEN '{code}' THEN {minutes * 60_000}" for code, minutes in codes.items()) + " END"
    return select(ticks() + "," + ",".join(parts) + f",\nevery AS ({union})", quality("every", length))


def completeness(by: str) -> str:
    return select(silver(by), """SELECT symbol, "interval", date_trunc('day', open_time) AS trading_day,
  count(*) AS bar_count, CAST(sum(CASE WHEN is_synthetic THEN 1 ELSE 0 END) AS BIGINT) AS synthetic_bar_count,
  min(open_time) AS first_bar, max(open_time) AS last_bar
FROM silver GROUP BY 1, 2, 3""")


def integrity(source: str) -> str:
    columns = [c.strip() for c in SILVER.split(",")][3:]
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in columns)
    total = " + ".join(f"null_{c}" for c in columns)
    return f"""SELECT *, CASE WHEN duplicate_keys > 0 OR {total} > 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT {KEY}, count(*) AS row_count, count(open_time) - count(DISTINCT open_time) AS duplicate_keys, {nulls}
  FROM {source} GROUP BY ALL)"""


def newest(source: str, count: int) -> str:
    return (
        f"SELECT {rounded(SILVER)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY open_time DESC) <= {count}"
    )


def loaded_window() -> str:
    """Typed bars of the window, cleaned and with features, as one load of it leaves them."""
    inside = f", inside AS (SELECT * FROM typed WHERE open_time BETWEEN {START} AND {END})"
    return raw() + inside + dedup("inside") + fill("latest") + features("silver")


def corrected() -> str:
    """Serving rows after an initial load and a later correction of the closes."""
    return bars() + """,
initial AS (SELECT * FROM bars WHERE open_time < TIMESTAMP '2024-01-20'),
revised AS (
  SELECT * REPLACE (close + 2 AS close, ingested_at + INTERVAL 1 MINUTE AS ingested_at)
  FROM bars WHERE open_time >= TIMESTAMP '2024-01-15')""" + features("initial", "old") + features(
        "revised", "new"
    ) + f""",
merged AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING ({PK}))"""


def pages() -> str:
    """Landed pages with the day they cover and the number of the day they were fetched."""
    return raw() + f""",
pages AS (SELECT {KEY}, CAST(open_time AS DATE) AS covered, max(ingested_at) AS ingested_at,
                 date_diff('day', DATE '2024-01-01', CAST(max(ingested_at) AS DATE)) AS day FROM typed GROUP BY {KEY}, covered)"""


def cut_loads(fill_gaps: bool) -> str:
    """Three loads of sparse series; features over all that is stored, however it was cut."""
    edges = (("2024-01-01", "2024-01-12"), ("2024-01-20", "2024-02-01"), ("2024-01-12", "2024-01-20"))
    steps = raw(BY_USER)
    for i, (low, high) in enumerate(edges):
        steps += f", part{i} AS (SELECT * FROM typed WHERE open_time BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '{high}')"
        steps += dedup(f"part{i}", f"load{i}")
        if fill_gaps:
            steps += fill(f"load{i}", f"filled{i}")
    # A bar on the edge of two loads is the same in both.
    parts = [f"SELECT {SILVER}, {i} AS turn FROM {'filled' if fill_gaps else 'load'}{i}" for i in range(len(edges))]
    steps += ", every AS (" + " UNION ALL ".join(parts) + f"""),
all_loads AS (SELECT {SILVER} FROM every QUALIFY row_number() OVER (PARTITION BY {PK} ORDER BY turn DESC) = 1)"""
    return steps + features("all_loads")


def two_loads() -> str:
    """Two incremental loads: the look-back first, then what follows the mark of each series."""
    first, second = "TIMESTAMP '2024-01-10 00:30:00'", "TIMESTAMP '2024-02-01 00:30:00'"
    return raw() + f""",
due1 AS (SELECT * FROM typed WHERE open_time BETWEEN {first} - INTERVAL 14 DAY AND {first})""" + dedup(
        "due1", "latest1"
    ) + fill("latest1", "silver1") + f""",
marks AS (SELECT {KEY}, max(open_time) + INTERVAL 1 HOUR AS start FROM silver1 GROUP BY ALL),
due2 AS (SELECT d.* FROM typed d JOIN marks m USING ({KEY}) WHERE d.open_time BETWEEN m.start AND {second})""" + dedup(
        "due2", "latest2"
    ) + fill("latest2", "silver2") + f""",
both_loads AS (SELECT {SILVER} FROM silver1 UNION ALL SELECT {SILVER} FROM silver2)""" + features("both_loads")


def refreshed() -> str:
    """A load of everything, whose newest five bars are then loaded again; those since the 29th have another close."""
    return raw() + dedup() + fill("latest", "before") + f""",
newest AS (SELECT {SILVER} FROM latest QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY open_time DESC) <= 5),
revised AS (
  SELECT * REPLACE (CASE WHEN open_time >= TIMESTAMP '2024-01-29' THEN close + 2 ELSE close END AS close,
                    CASE WHEN open_time >= TIMESTAMP '2024-01-29' THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END
                      AS ingested_at) FROM newest)""" + fill("revised", "again") + f""",
silver AS (SELECT * FROM again UNION ALL SELECT * FROM before ANTI JOIN again USING ({PK}))""" + features("silver")


GOLD_ROWS = f"SELECT {rounded(SILVER + ', ' + FEATURES)} FROM gold"
SILVER_ROWS = f"SELECT {rounded(SILVER)} FROM"
STREAM = select(rule_rows() + ", " + ticks() + alert_rows("ticks", "spot"), "SELECT * FROM events_out")


def statements() -> dict[str, str]:
    by_user_features = bars(BY_USER) + features("bars")

    def pick(columns: str) -> str:
        return select(by_user_features, f"SELECT {rounded(f'{PK}, {columns}')} FROM gold")

    out = {
        "kline_payload_parse": select(
            raw(),
            f"""SELECT {KEY}, epoch_ms(open_time) AS open_time, epoch_ms(close_time) AS close_time,
  {rounded("open, high, low, close, quote_volume")}, CAST(trade_count AS DOUBLE) AS trade_count,
  {rounded("taker_buy_base_volume, taker_buy_quote_volume")},
  coalesce(CAST(volume AS VARCHAR), 'bad') AS volume, '0' AS ignore, load_source,
  max(ingested_at) OVER (PARTITION BY {KEY}, CAST(open_time AS DATE)) AS ingested_at FROM typed""",
        ),
        "pages_rejected": select(
            pages(),
            f"""SELECT {KEY}, ingested_at, CASE WHEN day % 11 = 3 THEN 'no payload' ELSE 'payload is not an array of bars' END
  AS reject_reason FROM pages WHERE day % 11 = 3 OR day % 7 = 2""",
        ),
        "pages_partly_read": select(
            pages(),
            f"""SELECT {KEY}, count(*) AS bars, min(epoch_ms(open_time)) AS first, max(epoch_ms(open_time)) AS last
FROM typed JOIN pages USING ({KEY}) WHERE CAST(open_time AS DATE) = covered AND day % 11 <> 3 AND day % 7 <> 2 GROUP BY ALL""",
        ),
        "extract_window_bars": select(
            raw(),
            f"SELECT {KEY}, epoch_ms(open_time) AS open_time, round(close, 6) AS close, ingested_at FROM typed "
            f"WHERE open_time BETWEEN {START} AND {END}",
        ),
        "recent_bars_of_series": select(bars(BY_USER), newest("bars", 5)),
        "latest_price": select(
            ticks(BY_USER),
            "SELECT exchange, symbol, round(arg_max(price, event_time), 6) AS price, max(event_time) AS event_time "
            "FROM ticks GROUP BY ALL",
        ),
        "normalize": select(raw(), f"{SILVER_ROWS} typed"),
        "dedup_latest": select(raw() + dedup(), f"{SILVER_ROWS} latest"),
        "fill_gaps": select(bars() + fill("bars"), f"{SILVER_ROWS} silver"),
        "clean": select(silver(), f"{SILVER_ROWS} silver"),
        "clean_users": select(silver(BY_USER), f"{SILVER_ROWS} silver"),
        "clean_small_chunks": select(silver(BY_USER), f"{SILVER_ROWS} silver"),
        "clean_without_fill": select(raw() + dedup(), f"{SILVER_ROWS} latest"),
        "simple_returns": pick("return_1, return_5, return_20"),
        "log_returns": pick("log_return_1"),
        "moving_averages": pick("ma_5, ma_20, ma_50"),
        "rolling_volatility": pick("vol_5, vol_20"),
        "features": select(silver() + features("silver"), GOLD_ROWS),
        "features_users": select(silver(BY_USER) + features("silver"), GOLD_ROWS),
        "features_small_chunks": pick(FEATURES),
        "features_five_minutes": select(bars(BY_TYPE, "5m", 5) + fill("bars", minutes=5) + features("silver"), GOLD_ROWS),
        "features_daily": select(bars(BY_USER, "1d", 1440) + fill("bars", minutes=1440) + features("silver"), GOLD_ROWS),
        "quality_report_intervals": all_intervals(),
        "latest_bars_top20": select(
            silver() + features("silver"),
            f"""SELECT {rounded("open_time, open, high, low, close, volume, return_1, ma_5, ma_20, vol_5")}
FROM gold WHERE symbol = 'click' AND "interval" = '1h' ORDER BY open_time DESC LIMIT 20""",
        ),
        "completeness_by_day": completeness(BY_TYPE),
        "completeness_by_day_users": completeness(BY_USER),
        "volatility_top50": select(
            silver() + features("silver"),
            f"""SELECT {rounded('symbol, "interval", open_time, close, vol_20')} FROM gold
WHERE "interval" = '1h' AND vol_20 IS NOT NULL
QUALIFY row_number() OVER (ORDER BY gold.vol_20 DESC, open_time DESC, symbol) <= 50""",
        ),
        "quality_report": select(bars(BY_USER), quality("bars")),
        "quality_report_filled": select(silver(BY_USER), quality("silver")),
        "quality_report_duplicates": select(raw(BY_USER), quality("typed")),
        "integrity": select(raw(BY_USER), integrity("typed")),
        "integrity_rejects": select(
            silver(), f"SELECT {PK}, round(close, 6) AS close, 'volume' AS missing FROM silver WHERE volume IS NULL"
        ),
        "integrity_duplicates": select(
            raw(), f"SELECT {PK}, count(*) AS copies FROM typed GROUP BY ALL HAVING count(*) > 1"
        ),
        "rules_valid": select(rule_rows(BY_USER), "SELECT * FROM rules"),
        "rules_rejected": select(
            rule_rows(BY_USER),
            """SELECT symbol || '|cross_above|106' AS rule, 'expected 4 or 5 parts separated by |' AS reject_reason
FROM symbols UNION ALL SELECT symbol || '|sideways|106|' || symbol || '_sideways', 'unsupported direction' FROM symbols
UNION ALL SELECT symbol || '|above|abc|' || symbol || '_text', 'threshold is not a number' FROM symbols""",
        ),
        "alerts": STREAM,
        "alerts_users": select(
            rule_rows(BY_USER) + ", " + ticks(BY_USER) + alert_rows("ticks", "spot"), "SELECT * FROM events_out"
        ),
        "alerts_many_rules": select(
            LADDER + ", " + ticks() + alert_rows("ticks", "spot"), "SELECT * FROM events_out"
        ),
        "alerts_on_bars": select(
            rule_rows() + ", " + bars() + """,
closes AS (SELECT exchange, symbol, open_time AS event_time, close AS price, load_source AS source FROM bars)"""
            + alert_rows("closes", "1h"),
            "SELECT * FROM events_out",
        ),
        "signal_event_records": select(
            rule_rows() + ", " + ticks() + alert_rows("ticks", "spot"),
            """SELECT signal_name, symbol, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
  observed_value, 'threshold_alert' AS event_type FROM events_out""",
        ),
        "positions": results("target_position, position"),
        "strategy_returns": results(
            "round(asset_return, 6) AS asset_return, turnover, round(transaction_cost, 6) AS transaction_cost, "
            "round(strategy_return, 6) AS strategy_return"
        ),
        "equity_curve": results("round(equity_curve, 2) AS equity_curve"),
        "drawdown": results("round(drawdown, 6) AS drawdown"),
        "performance": select(silver() + strategy("silver"), "SELECT * FROM performance"),
        "performance_users": select(silver(BY_USER) + strategy("silver"), "SELECT * FROM performance"),
        "performance_small_chunks": select(silver() + strategy("silver"), "SELECT * FROM performance"),
        "performance_crossing": select(
            silver() + strategy("silver", CROSS_ONLY),
            "SELECT * REPLACE (lower(symbol) || '_entry/' || lower(symbol) || '_exit' AS strategy_id) FROM performance",
        ),
        "strategy_csv": results(
            "target_position, round(strategy_return, 6) AS strategy_return, round(equity_curve, 2) AS equity_curve"
        ),
        "layer_roundtrip": select(
            bars(), f"SELECT {rounded(SILVER)}, strftime(open_time, '%Y-%m-%d') AS date FROM bars"
        ),
        "layer_window_scan": select(
            raw(), f"{SILVER_ROWS} typed WHERE symbol = 'click' AND open_time BETWEEN {START} AND {END}"
        ),
        "layer_day_layout": select(bars(BY_USER), f"{SILVER_ROWS} bars WHERE open_time BETWEEN {START} AND {END}"),
        "serving_merge": select(corrected(), GOLD_ROWS.replace("FROM gold", "FROM merged")),
        "serving_upsert": select(corrected(), GOLD_ROWS.replace("FROM gold", "FROM merged")),
        "high_water_mark": select(
            silver(BY_USER),
            f"""SELECT 'historical_backfill:' || exchange || ':' || symbol || ':' || "interval" AS mark_key, {KEY},
  max(open_time) AS last_success_open_time, count(*) AS last_row_count FROM silver GROUP BY ALL""",
        ),
        "load_summary": select(
            loaded_window(),
            f"""SELECT 'historical_backfill' AS job_name, {KEY}, e.n AS rows_extracted, c.n AS rows_cleaned,
  c.n AS rows_loaded, 'success' AS status
FROM (SELECT {KEY}, count(*) AS n FROM inside GROUP BY ALL) e
JOIN (SELECT {KEY}, count(*) AS n FROM silver GROUP BY ALL) c USING ({KEY})""",
        ),
        "window_load": select(loaded_window(), GOLD_ROWS),
        "staged_load": select(loaded_window(), GOLD_ROWS),
        "staged_quality": select(loaded_window(), quality("gold")),
        "incremental_due": select(
            raw() + f""",
marks AS (SELECT {KEY}, max(open_time) + INTERVAL 1 HOUR AS start FROM typed
          WHERE open_time < TIMESTAMP '2024-01-22' AND symbol <> 'view' GROUP BY ALL)""",
            f"""SELECT {rounded(SILVER)} FROM typed LEFT JOIN marks USING ({KEY})
WHERE open_time BETWEEN coalesce(start, {NOW} - INTERVAL 1 DAY) AND {NOW}""",
        ),
        "load_summary_rejects": select(
            raw() + f""",
faulty AS (SELECT * REPLACE (CASE WHEN trade_count % 13 <> 0 THEN symbol END AS symbol,
                             CASE WHEN trade_count % 17 = 0 THEN open_time + INTERVAL 30 MINUTE WHEN trade_count % 7 <> 0 THEN open_time END AS open_time)
           FROM typed WHERE open_time < TIMESTAMP '2024-02-01')""",
            f"""SELECT {KEY}, count(*) AS rows_extracted,
  count(*) FILTER (WHERE symbol IS NULL OR open_time IS NULL OR (epoch_ms(open_time) - epoch_ms(first)) % 3600000 <> 0) AS rows_rejected,
  'success' AS status
FROM (SELECT *, min(open_time) OVER (PARTITION BY {KEY}) AS first FROM faulty) GROUP BY ALL""",
        ),
        "incremental_batch": select(two_loads(), GOLD_ROWS),
        "incremental_gap_features": select(cut_loads(False), GOLD_ROWS),
        "backfill_gap_features": select(cut_loads(True), GOLD_ROWS),
        "recent_raw_bars": select(raw(BY_USER) + dedup(), newest("latest", 5)),
        "realtime_refresh": select(refreshed(), GOLD_ROWS),
        "stream_alerts": STREAM,
        "stream_alerts_unordered": STREAM,
        "stream_alerts_continuous": STREAM,
        "stream_ticks": select(
            ticks(),
            "SELECT exchange, symbol, event_time, round(price, 6) AS price, source, ingested_at FROM ticks",
        ),
        "stream_cycles": select(
            rule_rows() + ", " + ticks() + alert_rows("ticks", "spot") + """,
parts AS (SELECT event_time >= TIMESTAMP '2024-01-11' AS a, event_time >= TIMESTAMP '2024-01-21' AS b, 1 AS tick, 0 AS alert
          FROM ticks UNION ALL
          SELECT event_time >= TIMESTAMP '2024-01-11', event_time >= TIMESTAMP '2024-01-21', 0, 1 FROM events_out)""",
            "SELECT CAST(sum(tick) AS BIGINT) AS tick_count, CAST(sum(alert) AS BIGINT) AS alert_count, "
            "CAST(0 AS BIGINT) AS late_count, CAST(CAST(a AS INT) + CAST(b AS INT) AS BIGINT) AS batch_id FROM parts GROUP BY a, b",
        ),
    }
    return out
