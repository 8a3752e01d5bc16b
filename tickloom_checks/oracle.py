"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from tickloom import schema
from tickloom_checks.fixtures import BARS_SQL, ORDER_ROWS_SQL, SUPPLIER_ROWS_SQL
from tickloom_checks.words import DATA_PIECES, MANY_PIECES, PREDICTION_PIECES, TICKER_PIECES

W = "PARTITION BY ticker ORDER BY date"
RAW = ["open", "high", "low", "close"]
INDICATORS = [c.lower() for c in schema.INDICATOR_COLUMNS]


def over(n: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def r4(*names: str) -> str:
    """Rounded columns; adding zero turns DuckDB's -0.0 into 0.0, the only zero that Spark's round gives."""
    return ", ".join(f"round({n}, 4) + 0.0::DOUBLE AS {n}" for n in names)


CHANGES_SQL = f"""lagged AS (
  SELECT *, lag(close) OVER ({W}) AS prev_close FROM bars),
changes AS (
  SELECT *, close - prev_close AS change,
         CASE WHEN close > prev_close THEN close - prev_close ELSE 0.0::DOUBLE END AS gain,
         CASE WHEN close < prev_close THEN prev_close - close ELSE 0.0::DOUBLE END AS loss,
         (close - prev_close) / nullif(prev_close, 0) AS daily_return
  FROM lagged)"""

FRAMES_SQL = f"""frames AS (
  SELECT *, avg(close) {over(7)} AS ma_7, avg(close) {over(30)} AS ma_30, avg(close) {over(90)} AS ma_90,
         avg(gain) {over(14)} AS avg_gain, avg(loss) {over(14)} AS avg_loss,
         stddev_samp(close) {over(30)} AS volatility,
         avg(daily_return) {over(30)} AS mean_ret, stddev_samp(daily_return) {over(30)} AS std_ret
  FROM changes),
indicators AS (
  SELECT *, 100 - 100 / (1 + CASE WHEN avg_loss = 0 THEN 100 ELSE avg_gain / avg_loss END) AS rsi,
         CASE WHEN std_ret = 0 THEN 0 ELSE mean_ret / std_ret END AS sharpe_ratio
  FROM frames)"""

FEATURES_SQL = f"""features AS (
  SELECT ticker, date, open, high, low, close, volume, {", ".join(INDICATORS)}
  FROM indicators
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in RAW + ["volume"] + INDICATORS)})"""

ENGINEERED_SQL = f"""engineered AS (
  SELECT *, (close - first_value(close) OVER ({W})) / nullif(first_value(close) OVER ({W}), 0) AS total_return,
         close / nullif(lag(close, 7) OVER ({W}), 0) - 1 AS return_7d,
         close / nullif(lag(close, 30) OVER ({W}), 0) - 1 AS return_30d,
         (ma_7 - ma_30) / nullif(ma_30, 0) AS ma7_vs_ma30,
         (ma_30 - ma_90) / nullif(ma_90, 0) AS ma30_vs_ma90,
         CASE WHEN count(rsi) {over(14)} = 14 THEN avg(rsi) {over(14)} END AS avg_rsi
  FROM features)"""

SCORED_SQL = """scored AS (
  SELECT *, round(
      least(greatest(total_return * 100, 0), 10) * 0.30::DOUBLE
    + (CASE WHEN ma7_vs_ma30 > 0 AND ma30_vs_ma90 > 0 THEN 8.0::DOUBLE
            WHEN ma7_vs_ma30 < 0 AND ma30_vs_ma90 < 0 THEN 2.0::DOUBLE ELSE 5.0::DOUBLE END) * 0.20::DOUBLE
    + (10.0::DOUBLE - abs(coalesce(rsi, 50) - 50) / 5) * 0.15::DOUBLE
    + greatest(10.0::DOUBLE - coalesce(volatility, 10) / 5, 0) * 0.15::DOUBLE
    + least(greatest((coalesce(sharpe_ratio, 0) + 1) * 5, 0), 10) * 0.20::DOUBLE, 2) AS composite_score
  FROM engineered),
labelled AS (
  SELECT *, CASE WHEN composite_score >= 7 THEN 'High' WHEN composite_score >= 4 THEN 'Medium' ELSE 'Low' END AS label
  FROM scored)"""

LAGS_SQL = "lags AS (\n  SELECT ticker, date, open, high, low, close, volume,\n         " + ",\n         ".join(
    f"lag({c.lower()}, {k}) OVER ({W}) AS {c.lower()}_lag_{k}"
    for c in schema.LAG_COLUMNS
    for k in range(1, schema.LAG_DEPTH + 1)
) + f",\n         lead(close) OVER ({W}) AS target\n  FROM bars)"

NEWEST_SQL = """newest AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM features),
state AS (
  SELECT ticker, max(date) AS last_date, arg_max(close, date) AS last_price, avg(daily_return) AS mean_return
  FROM newest WHERE rn <= 30 GROUP BY ticker)"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


BARS = (ORDER_ROWS_SQL, BARS_SQL)
CHANGES = (*BARS, CHANGES_SQL)
FRAMES = (*CHANGES, FRAMES_SQL)
FEATURES = (*FRAMES, FEATURES_SQL)
ENGINEERED = (*FEATURES, ENGINEERED_SQL)
LABELLED = (*ENGINEERED, SCORED_SQL)
LAGS = (*BARS, LAGS_SQL)
NEWEST = (*FEATURES, NEWEST_SQL)
SUPPLIER_FEATURES = (SUPPLIER_ROWS_SQL, BARS_SQL, CHANGES_SQL, FRAMES_SQL, FEATURES_SQL)

FEATURE_COLUMNS = f"ticker, date, {r4(*RAW)}, volume, {r4(*INDICATORS)}"
ENGINEERED_COLUMNS = ["total_return", "return_7d", "return_30d", "ma7_vs_ma30", "ma30_vs_ma90", "avg_rsi"]
LAG_NAMES = [f"{c.lower()}_lag_{k}" for c in schema.LAG_COLUMNS for k in range(1, schema.LAG_DEPTH + 1)]
BAR_COLUMNS = f"ticker, date, {r4(*RAW)}, volume"


def _quality(source: str) -> str:
    return f"""quality AS (
  SELECT ticker, count(*) AS n_rows, count(*) < 200 AS too_few_rows,
         count(*) FILTER (WHERE open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL) > 0
           AS has_missing,
         count(*) > count(DISTINCT date) AS has_duplicate_dates,
         count(*) FILTER (WHERE close <= 0) > 0 AS has_bad_close
  FROM {source} GROUP BY ticker),
verdict AS (
  SELECT *, NOT (too_few_rows OR has_missing OR has_duplicate_dates OR has_bad_close) AS valid FROM quality)"""


UNMERGED = f"""{ORDER_ROWS_SQL},
unmerged AS (
  SELECT ticker, date, price AS open, price AS high, price AS low, price AS close, 1::BIGINT AS volume
  FROM order_rows)"""

QUALITY_COLUMNS = "ticker, CAST(n_rows AS BIGINT) AS n_rows, too_few_rows, has_missing, has_duplicate_dates, has_bad_close, valid"

CHRONO_SQL = """numbered AS (
  SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date) AS row_num,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM bars)"""
CHRONO_SELECT = """SELECT ticker, date, row_num,
  CASE WHEN row_num <= floor(n * 0.8::DOUBLE) THEN 'train'
       WHEN row_num <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM numbered"""

STRATIFIED_SELECT = """SELECT ticker, date, label,
  CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(ticker || '|' || CAST(date AS VARCHAR) || '|42'))
            <= floor(count(*) OVER (PARTITION BY label) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM labelled"""

DUPLICATE_KEYS_SELECT = """SELECT ticker, date, label,
  CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(ticker || '|42'), date)
            <= floor(count(*) OVER (PARTITION BY label) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM labelled"""

SAMPLED_SELECT = f"""SELECT ticker, date, label, CASE WHEN (CAST(('0x' || substr(md5(ticker || '|' || CAST(date AS VARCHAR) || '|42'), 1, 13)) AS BIGINT) + 1)::DOUBLE
  / {16**13}::DOUBLE <= 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM labelled"""

# Substrings of the length of a ticker, looked up in the list.
MANY_TICKERS_SQL = f"""WITH listed AS (
  SELECT unnest({list(MANY_PIECES)}) AS name, unnest(range({len(MANY_PIECES)})) AS rank),
found AS (
  SELECT conv_id, turn, min(rank) AS rank FROM (
    SELECT DISTINCT conv_id, turn, unnest(list_transform(range(1, length(text) - 2), lambda i: substr(lower(text), i, 4))) AS piece FROM conversations)
  JOIN listed ON piece = lower(name) GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, name AS ticker FROM conversations c LEFT JOIN found USING (conv_id, turn) LEFT JOIN listed USING (rank)"""

# Test rows of a series: complete lag rows lack the first 30 and the last row.
TEST_ROWS_SELECT = """SELECT ticker, CAST(k - floor(k * 0.8::DOUBLE) - floor(k * 0.1::DOUBLE) AS BIGINT) AS n, true AS ordered, true AS finite
FROM (SELECT ticker, count(*) - 31 AS k FROM features GROUP BY ticker) WHERE k > 0"""

SAME_ROWS_SELECT = f"SELECT ticker, n, true AS equal FROM ({TEST_ROWS_SELECT})"

# The pooled model splits before it makes lags, so only the last row lacks its target.
POOLED_TEST_ROWS_SELECT = """SELECT ticker, CAST(k - floor(k * 0.8::DOUBLE) - floor(k * 0.1::DOUBLE) AS BIGINT) - 1 AS n, true AS ordered, true AS finite
FROM (SELECT ticker, count(*) AS k FROM features GROUP BY ticker)"""

SUPPORT_SELECT = """SELECT label AS class, support, true AS sound FROM
  (SELECT label, CAST(count(*) - floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS support FROM labelled GROUP BY label) WHERE support > 0
UNION ALL SELECT c, CAST(sum(n - floor(n * 0.8::DOUBLE)) AS BIGINT), true
FROM (SELECT count(*) AS n FROM labelled GROUP BY label), (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(c) GROUP BY c"""

BOARD_SELECT = """SELECT ticker, printf('$%.2f', round(close, 2)) AS price, printf('%.1f', round(rsi, 1)) AS rsi,
  printf('%.2f', round(sharpe_ratio, 2)) AS sharpe, composite_score, true AS sums_to_100, true AS grade_is_likeliest
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM labelled) WHERE rn = 1"""

CONTRACT_SQL = """SELECT count(*) FILTER (WHERE toxic = 1) AS bad_labels, count(*) FILTER (WHERE quality = 0) AS bad_sums FROM labels"""

METRICS_SELECT = """pairs AS (
  SELECT ticker, close AS p, lead(close) OVER (PARTITION BY ticker ORDER BY date) AS y FROM bars),
known AS (SELECT * FROM pairs WHERE y IS NOT NULL)
SELECT ticker, count(*) AS n, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse, round(avg(abs(p - y)), 4) AS mae,
       round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 4) AS r2,
       round(avg(abs(p - y) / y) * 100, 4) AS mpe
FROM known GROUP BY ticker"""

REPORT_SQL = """WITH pairs AS (SELECT CAST(quality AS VARCHAR) AS label, CAST(toxic AS VARCHAR) AS prediction FROM labels),
classes AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs),
counts AS (
  SELECT class, count(*) FILTER (WHERE label = class AND prediction = class) AS hit,
         count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE prediction = class) AS predicted
  FROM classes, pairs GROUP BY class),
measures AS (
  SELECT class, hit, support, coalesce(hit / nullif(predicted, 0)::DOUBLE, 0) AS precision,
         coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall,
         coalesce(2 * hit / nullif(predicted + support, 0)::DOUBLE, 0) AS f1
  FROM counts),
report AS (
  SELECT class, precision, recall, f1, support FROM measures
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support)
  FROM measures
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM measures
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM measures)
SELECT class, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       CAST(support AS BIGINT) AS support FROM report"""


def _uniform(tag: str) -> str:
    text = f"ticker || '|' || CAST(step AS VARCHAR) || '|42|{tag}'"
    return f"((CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) + 1)::DOUBLE / {16**13}::DOUBLE)"


STEPS = "steps AS (SELECT *, CAST(unnest(generate_series(1, {n})) AS INTEGER) AS step FROM state)"
PLAIN_FORECAST = """SELECT ticker, step, CAST(last_date + step AS DATE) AS forecast_date,
  round(last_price * pow(1 + mean_return, step), {d}) AS price FROM steps"""
NOISY_FORECAST = f"""growth AS (
  SELECT *, 1 + mean_return
         + 0.01::DOUBLE * sqrt(-2 * ln({_uniform("u")})) * cos(2 * pi() * {_uniform("v")}) AS g FROM steps)
SELECT ticker, step, CAST(last_date + step AS DATE) AS forecast_date,
  round(last_price * product(g) OVER (PARTITION BY ticker ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
    AS price FROM growth"""


def _intent(tickers, prediction, data) -> str:
    def any_of(words):
        return "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"

    named = "CASE " + " ".join(f"WHEN contains(lower(text), '{t.lower()}') THEN '{t.upper()}'" for t in tickers) + " END"
    return f"""SELECT conv_id, turn, CASE WHEN {any_of(prediction)} THEN 'prediction' WHEN {any_of(data)} THEN 'data'
  WHEN ({named}) IS NOT NULL THEN 'prediction' ELSE 'chat' END AS intent, {named} AS ticker FROM conversations"""


def oracle_sql() -> dict[str, str]:
    features = with_(*FEATURES, select=f"SELECT {FEATURE_COLUMNS} FROM features")
    suppliers = with_(
        SUPPLIER_ROWS_SQL, BARS_SQL, CHANGES_SQL, FRAMES_SQL, FEATURES_SQL,
        select=f"SELECT {FEATURE_COLUMNS} FROM features",
    )
    engineered = with_(*ENGINEERED, select=f"SELECT ticker, date, {r4(*ENGINEERED_COLUMNS)} FROM engineered")
    lags = with_(
        *LAGS,
        select=f"SELECT ticker, date, {r4(*RAW)}, volume, "
        + ", ".join(n if n.startswith("volume") else f"round({n}, 4) AS {n}" for n in LAG_NAMES)
        + ", round(target, 4) AS target FROM lags WHERE target IS NOT NULL AND close_lag_30 IS NOT NULL",
    )
    chrono = with_(*BARS, CHRONO_SQL, select=CHRONO_SELECT)
    stratified = with_(*LABELLED, select=STRATIFIED_SELECT)
    bars_out = with_(*BARS, select=f"SELECT {BAR_COLUMNS} FROM bars")
    latest = f"""SELECT ticker, date, {r4("close", "rsi", "ma_7", "ma_30", "daily_return")} FROM newest WHERE rn = 1"""
    serving = f"SELECT ticker, CAST(date AS VARCHAR) AS date, {r4(*RAW)}, volume, {r4(*INDICATORS)} FROM newest"
    return {
        "moving_averages": with_(*FRAMES, select=f"SELECT ticker, date, {r4('ma_7', 'ma_30', 'ma_90')} FROM frames"),
        "previous_close": with_(*CHANGES, select=f"SELECT ticker, date, {r4('prev_close', 'change')} FROM changes"),
        "rsi": with_(*FRAMES, select=f"SELECT ticker, date, {r4('rsi')} FROM indicators"),
        "volatility": with_(*FRAMES, select=f"SELECT ticker, date, {r4('volatility')} FROM frames"),
        "returns_sharpe": with_(
            *FRAMES, select=f"SELECT ticker, date, {r4('daily_return', 'sharpe_ratio')} FROM indicators"
        ),
        "feature_table": features,
        "feature_table_segmented": features,
        "feature_table_suppliers": suppliers,
        "lag_features": lags,
        "lag_features_segmented": lags,
        "scaled_lags": with_(
            *LAGS,
            select="SELECT ticker, date, "
            + ", ".join(
                f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 4) + 0.0::DOUBLE AS {c}"
                for c in (f"{n.lower()}_lag_1" for n in schema.LAG_COLUMNS)
            )
            + " FROM lags WHERE target IS NOT NULL AND close_lag_30 IS NOT NULL",
        ),
        "feature_matrix": with_(*LABELLED, select=f"SELECT label, {r4(*schema.CLASSIFIER_FEATURES)} FROM labelled"),
        "total_return": with_(*ENGINEERED, select=f"SELECT ticker, date, {r4('total_return')} FROM engineered"),
        "percent_change": with_(
            *ENGINEERED, select=f"SELECT ticker, date, {r4('return_7d', 'return_30d')} FROM engineered"
        ),
        "rolling_mean_full": with_(*ENGINEERED, select=f"SELECT ticker, date, {r4('avg_rsi')} FROM engineered"),
        "trend_ratios": with_(
            *ENGINEERED, select=f"SELECT ticker, date, {r4('ma7_vs_ma30', 'ma30_vs_ma90')} FROM engineered"
        ),
        "classifier_features": engineered,
        "classifier_features_segmented": engineered,
        "composite_score": with_(*LABELLED, select="SELECT ticker, date, composite_score FROM labelled"),
        "grade_labels": with_(*LABELLED, select="SELECT ticker, date, composite_score, label FROM labelled"),
        "grade_counts": with_(
            *LABELLED,
            select="""SELECT g.label, count(l.label) AS n FROM (VALUES ('High'), ('Medium'), ('Low')) g(label)
LEFT JOIN labelled l ON l.label = g.label GROUP BY g.label""",
        ),
        "rsi_zones": with_(
            *FEATURES,
            select="""SELECT ticker, date, CASE WHEN rsi >= 70 THEN 'overbought' WHEN rsi <= 30 THEN 'oversold'
  ELSE 'neutral' END AS rsi_zone FROM features""",
        ),
        "latest_prices": with_(*NEWEST, select=latest),
        "latest_rows": with_(*NEWEST, select=f"SELECT {FEATURE_COLUMNS} FROM newest WHERE rn <= 30"),
        "latest_rows_one_series": with_(
            *NEWEST, select=f"SELECT {FEATURE_COLUMNS} FROM newest WHERE rn <= 30 AND ticker = '1-URGENT'"
        ),
        "series_history": with_(*FEATURES, select=f"SELECT {FEATURE_COLUMNS} FROM features WHERE ticker = '1-URGENT'"),
        "ordered_table": features,
        "numbered_table": with_(*FEATURES, select=f"SELECT {FEATURE_COLUMNS}, row_number() OVER (ORDER BY ticker, date) AS position FROM features"),
        "page_rows": with_(*NEWEST, select=f"SELECT {FEATURE_COLUMNS} FROM newest WHERE rn <= 180"),
        "sampled_split": with_(*LABELLED, select=SAMPLED_SELECT),
        "vendor_wide": bars_out,
        "bar_file_manifest": with_(*BARS, select="SELECT ticker, count(*) AS n_rows, true AS named FROM bars GROUP BY ticker"),
        "bucketed_latest": with_(
            *SUPPLIER_FEATURES, NEWEST_SQL, select=latest.replace("ticker, date,", "ticker, CAST(date AS VARCHAR) AS date,")
        ),
        "bucketed_average": with_(
            *SUPPLIER_FEATURES, select=f"SELECT ticker, CAST(date AS VARCHAR) AS date, round(avg(close) {over(7)}, 4) AS ma_7 FROM features"
        ),
        "kept_stock_rows": with_(*NEWEST, select=serving + " WHERE rn <= 30 AND ticker = '1-URGENT'"),
        "message_tickers_many": MANY_TICKERS_SQL,
        "gbt_forecast_many": with_(*SUPPLIER_FEATURES, select=TEST_ROWS_SELECT),
        "many_model_roundtrip": with_(*FEATURES, select=SAME_ROWS_SELECT),
        "forecaster_roundtrip": with_(*FEATURES, select=f"SELECT * FROM ({SAME_ROWS_SELECT}) WHERE ticker IN ('1-URGENT', '5-LOW')"),
        "classifier_roundtrip": with_(*LABELLED, select="SELECT ticker, count(*) AS n, true AS equal FROM labelled GROUP BY ticker"),
        "recent_mean_return": with_(*NEWEST, select=f"SELECT ticker, {r4('mean_return')} FROM state"),
        "distinct_series": with_(*BARS, select="SELECT DISTINCT ticker FROM bars"),
        "row_counts": with_(*BARS, select="SELECT count(*) AS n_rows FROM bars"),
        "data_quality": with_(*BARS, _quality("bars"), select=f"SELECT {QUALITY_COLUMNS} FROM verdict"),
        "data_quality_unmerged": with_(UNMERGED, _quality("unmerged"), select=f"SELECT {QUALITY_COLUMNS} FROM verdict"),
        "overall_quality": with_(*BARS, _quality("bars"), select="SELECT bool_and(valid) AS all_valid FROM verdict"),
        "missing_series": with_(
            *BARS,
            select="""SELECT e.ticker FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('AAPL'), ('TSLA')) e(ticker)
WHERE e.ticker NOT IN (SELECT ticker FROM bars)""",
        ),
        "enough_rows": with_(*BARS, select="SELECT count(*) >= 1000 AS enough_rows FROM bars"),
        "chronological_split": chrono,
        "chronological_split_segmented": chrono,
        "validation_rows": with_(
            *BARS, CHRONO_SQL,
            select="SELECT ticker, date, row_num FROM numbered WHERE row_num > 100 AND row_num <= 200",
        ),
        "stratified_split": stratified,
        "stratified_split_selected": stratified,
        "stratified_split_duplicate_keys": with_(*LABELLED, select=DUPLICATE_KEYS_SELECT),
        "stratified_split_duplicate_keys_selected": with_(*LABELLED, select=DUPLICATE_KEYS_SELECT),
        "gbt_forecast": with_(*FEATURES, select=TEST_ROWS_SELECT),
        "gbt_forecast_pooled": with_(*FEATURES, select=POOLED_TEST_ROWS_SELECT),
        "grade_classifier": with_(*LABELLED, select=SUPPORT_SELECT),
        "grade_board": with_(*LABELLED, select=BOARD_SELECT),
        "prediction_contract": CONTRACT_SQL,
        "trained_contract": "SELECT 0::BIGINT AS bad_labels, 0::BIGINT AS bad_sums",
        "bar_files": bars_out,
        "collect_preprocess": features,
        "zscore": with_(
            *FEATURES,
            select="""SELECT ticker, date,
  round(CASE WHEN stddev_samp(close) OVER (PARTITION BY ticker) = 0 THEN 0
    ELSE (close - avg(close) OVER (PARTITION BY ticker)) / stddev_samp(close) OVER (PARTITION BY ticker) END, 4) + 0.0::DOUBLE AS close_z,
  round(CASE WHEN stddev_samp(rsi) OVER (PARTITION BY ticker) = 0 THEN 0
    ELSE (rsi - avg(rsi) OVER (PARTITION BY ticker)) / stddev_samp(rsi) OVER (PARTITION BY ticker) END, 4) + 0.0::DOUBLE AS rsi_z
FROM features""",
        ),
        "regression_metrics": "WITH " + ",\n".join(BARS) + ",\n" + METRICS_SELECT,
        "accuracy": "SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM labels",
        "classification_report": REPORT_SQL,
        "drift_forecast": with_(*NEWEST, STEPS.format(n=7), select=PLAIN_FORECAST.format(d=4)),
        "drift_forecast_noise": "WITH " + ",\n".join([*NEWEST, STEPS.format(n=14), NOISY_FORECAST]),
        "forecast_table": with_(
            *NEWEST, STEPS.format(n=7),
            select="""SELECT ticker, step, strftime(last_date + step, '%b %d') AS day,
  printf('$%.2f', round(last_price * pow(1 + mean_return, step), 2)) AS price FROM steps""",
        ),
        "message_intent": _intent(TICKER_PIECES, PREDICTION_PIECES, DATA_PIECES),
        "message_intent_default": _intent(
            schema.DEFAULT_TICKERS,
            ("predict", "forecast", "next", "future", "price"),
            ("show", "data", "history", "tell me about", "info"),
        ),
        "stock_page_metrics": with_(
            *NEWEST,
            select="""SELECT ticker, printf('$%.2f', round(close, 2)) AS price, format('{:,}', volume) AS volume,
  printf('%.2f%%', round(daily_return * 100, 2)) AS daily_return, printf('%.1f', round(rsi, 1)) AS rsi
FROM newest WHERE rn = 1""",
        ),
        "stock_page": with_(
            *LABELLED, NEWEST_SQL, STEPS.format(n=7),
            """prices AS (SELECT ticker, string_agg(printf('$%.2f', round(last_price * pow(1 + mean_return, step), 2)), ' ' ORDER BY step) AS forecast
  FROM steps GROUP BY ticker),
grades AS (SELECT ticker, label FROM labelled QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)""",
            select="""SELECT ticker, printf('$%.2f', round(close, 2)) AS price, format('{:,}', volume) AS volume,
  printf('%.2f%%', round(daily_return * 100, 2)) AS daily_return, printf('%.1f', round(rsi, 1)) AS rsi, label AS grade,
  (CASE WHEN label = 'High' THEN 100 ELSE 0 END)::DOUBLE AS high_percent, (CASE WHEN label = 'Medium' THEN 100 ELSE 0 END)::DOUBLE AS medium_percent,
  (CASE WHEN label = 'Low' THEN 100 ELSE 0 END)::DOUBLE AS low_percent, forecast
FROM newest JOIN grades USING (ticker) JOIN prices USING (ticker) WHERE rn = 1""",
        ),
        "stock_page_table": with_(
            *NEWEST, select=f"SELECT ticker, date, {r4(*RAW)}, volume, {r4('daily_return')} FROM newest WHERE rn <= 20"
        ),
        "answer_table": with_(
            *NEWEST,
            select="""SELECT ticker, date AS "Date", round(close, 4) AS "Close", round(rsi, 4) AS "RSI",
  round(ma_7, 4) AS "MA7", round(ma_30, 4) AS "MA30", round(daily_return, 4) AS "Daily Return"
FROM newest WHERE rn <= 10""",
        ),
        "union_series": with_(
            *BARS, select=f"SELECT {BAR_COLUMNS} FROM bars UNION ALL SELECT {BAR_COLUMNS} FROM bars WHERE ticker = '5-LOW'"
        ),
        "vendor_frame": with_(
            *BARS, select=f"SELECT 'ORDERS' AS ticker, date, {r4(*RAW)}, volume FROM bars"
        ),
        "csv_roundtrip": bars_out,
        "parquet_roundtrip": features,
        "table_roundtrip": with_(*NEWEST, select=serving),
        "table_preview": with_(
            *NEWEST,
            select=f"""SELECT ticker, CAST(date AS VARCHAR) AS date, {r4('close', 'rsi', 'ma_7')}
FROM newest WHERE rn <= 5 AND ticker = '1-URGENT'""",
        ),
    }
