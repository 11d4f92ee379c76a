"""The registered queries as SQL for an independent engine."""

from __future__ import annotations

# The wording that the SQL twin expects, written out on its own.
QUALITY_TEXT = {
    "good": "baik - model mampu menjelaskan tren dengan andal",
    "medium": "sedang - ada pola linier namun noise cukup tinggi",
    "low": "rendah - harga sangat fluktuatif dan sulit diprediksi secara linier",
}
ADVICE_TEXT = {
    "NAIK": "Pantau potensi kenaikan; pertimbangkan pembelian stok lebih awal.",
    "TURUN": "Harga cenderung turun; peluang pembelian stok dengan harga lebih murah.",
}

EVENTS = "(SELECT event_type AS entity, value AS price, ts, event_id AS id FROM events)"
USERS = "(SELECT user_id AS entity, value AS price, ts, event_id AS id FROM events)"


def items(entity: str) -> str:
    return f"""(SELECT {entity} AS entity, l_extendedprice / l_quantity AS price,
        p_retailprice AS baseline, l_shipdate AS ts, l_orderkey AS id, l_linenumber AS line,
        l_suppkey AS supplier
        FROM lineitem JOIN part ON l_partkey = p_partkey)"""


RAW = """(
    WITH base AS (
        SELECT event_type AS entity, CAST(value AS VARCHAR) AS price,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, event_id AS id
        FROM events),
    spelled AS (
        SELECT '  ' || CASE WHEN entity = 'view' THEN 'Page   VIEW' ELSE upper(entity) END || ' '
            AS entity, price, ts, id
        FROM base)
    SELECT * FROM base
    UNION ALL SELECT * FROM base
    UNION ALL SELECT * FROM spelled
    UNION ALL SELECT entity, '-' || price, ts, id FROM base
    UNION ALL SELECT entity, '0', ts, id FROM base
    UNION ALL SELECT entity, NULL, ts, id FROM base)"""


def canonical(column: str) -> str:
    key = f"lower(trim(regexp_replace({column}, '\\s+', ' ', 'g')))"
    return f"""CASE WHEN {key} = 'page view' THEN 'view'
        WHEN {key} IN ('click', 'error', 'purchase', 'signup', 'view') THEN {key}
        ELSE trim({column}) END"""


TYPED = """CAST(price AS DOUBLE) AS price, CAST(ts AS TIMESTAMP) AS ts,
    CAST(hour(CAST(ts AS TIMESTAMP)) AS INTEGER) AS hour, CAST(ts AS DATE) AS date"""

DOCS = "(SELECT doc_id AS id, lower(text) AS text FROM documents)"
# Words set off by single spaces.
WORDS = "' ' || trim(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' '"
KEYWORDS = """(VALUES ('view', 'eaux'), ('click', 'tion'), ('purchase', 'und'),
    ('error', 'lich'), ('signup', 'ment'), ('signup', 'the'), ('signup', 'of the'))
    AS k(entity, keyword)"""

VOLATILITY = """entity, max(price) AS price_max, min(price) AS price_min,
    round(avg(price), 8) AS price_avg, count(price) AS n,
    CASE WHEN min(price) <= 0 THEN 0.0
        ELSE round((max(price) - min(price)) / min(price) * 100, 8) END AS volatility_pct"""

PAGES = """(SELECT page_id AS id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    url AS link, html AS summary,
    regexp_extract(lower(url), '^[a-z]+://[^/?#]*\\.([a-z]+)(?:[/?#]|$)', 1) AS source
    FROM pages)"""


def changes(ticks: str) -> str:
    # Division by a zero price gives null, not infinity.
    return f"""(SELECT *, (price - prev_price) / nullif(prev_price, 0) * 100 AS pct_change FROM (
        SELECT *, lag(price) OVER (PARTITION BY entity ORDER BY ts, id) AS prev_price
        FROM {ticks}))"""


def alerts(ticks: str) -> str:
    return f"""(SELECT *, CASE WHEN pct_change > 5 THEN 'up' ELSE 'down' END AS alert
        FROM {changes(ticks)} WHERE pct_change > 5 OR pct_change < -5)"""


def two_back(entity: str) -> str:
    return f"""SELECT *, CASE WHEN prev_price = 0 THEN 0.0
        ELSE (price - prev_price) / prev_price * 100 END AS pct_change FROM (
        SELECT *, coalesce(lag(price, 2) OVER (
            PARTITION BY entity ORDER BY ts, id, line, supplier), baseline) AS prev_price
        FROM {items(entity)})"""


def features(ticks: str, order: str = "ts, id") -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY entity ORDER BY {order}) - 1 AS time_idx,
        count(*) OVER (PARTITION BY entity) AS n_total, CAST(hour(ts) AS INTEGER) AS hour
        FROM {ticks})"""


def split(ticks: str, order: str = "ts, id") -> str:
    return f"""(SELECT *, time_idx < n_train AS is_train FROM (
        SELECT *, CAST(greatest(floor(n_total * 0.8), 3) AS BIGINT) AS n_train
        FROM {features(ticks, order)} WHERE n_total >= 5))"""


def fitted(ticks: str, order: str = "ts, id", penalty: str = "mllib") -> str:
    """Penalised two-feature regression from the moments of the training rows."""
    if penalty == "mllib":
        lam, widen = "CASE WHEN sy > 0 THEN 0.01 / sy ELSE 0 END", "sqrt(n / (n - 1))"
    else:
        lam, widen = "0.01 / n", "1.0"
    return f"""(
        SELECT entity, my AS intercept, mt, mh, st * widen AS st, sh * widen AS sh,
            CASE WHEN st > 0 AND sy > 0
                THEN (a * rty - rth * rhy) / (a * a - rth * rth) * sy * widen ELSE 0 END
                AS coef_time,
            CASE WHEN sh > 0 AND sy > 0
                THEN (a * rhy - rth * rty) / (a * a - rth * rth) * sy * widen ELSE 0 END
                AS coef_hour
        FROM (
            SELECT *, 1 + {lam} AS a, {widen} AS widen,
                CASE WHEN st * sh > 0 THEN cth / (st * sh) ELSE 0 END AS rth,
                CASE WHEN st * sy > 0 THEN cty / (st * sy) ELSE 0 END AS rty,
                CASE WHEN sh * sy > 0 THEN chy / (sh * sy) ELSE 0 END AS rhy
            FROM (
                SELECT entity, CAST(count(*) AS DOUBLE) AS n,
                    avg(time_idx) AS mt, avg(hour) AS mh, avg(price) AS my,
                    stddev_pop(time_idx) AS st, stddev_pop(hour) AS sh, stddev_pop(price) AS sy,
                    covar_pop(time_idx, hour) AS cth, covar_pop(time_idx, price) AS cty,
                    covar_pop(hour, price) AS chy
                FROM {split(ticks, order)} WHERE is_train GROUP BY entity)))"""


def predicted(t: str, h: str) -> str:
    return f"""(intercept + coef_time * CASE WHEN st > 0 THEN ({t} - mt) / st ELSE 0 END
        + coef_hour * CASE WHEN sh > 0 THEN ({h} - mh) / sh ELSE 0 END)"""


def scored(ticks: str) -> str:
    parts = []
    for name, rows in (("train", "is_train"), ("test", "NOT is_train")):
        parts.append(f"""
            count(*) FILTER ({rows}) AS n_{name},
            CASE WHEN var_pop(price) FILTER ({rows}) > 0 THEN
                1 - avg(e * e) FILTER ({rows}) / var_pop(price) FILTER ({rows}) END AS r2_{name},
            sqrt(avg(e * e) FILTER ({rows})) AS rmse_{name},
            avg(abs(e)) FILTER ({rows}) AS mae_{name}""")
    return f"""(SELECT entity, count(*) AS n_total, {','.join(parts)} FROM (
        SELECT s.*, price - {predicted('time_idx', 'hour')} AS e
        FROM {split(ticks)} s JOIN {fitted(ticks)} m ON s.entity = m.entity)
        GROUP BY entity)"""


SCORES = ("r2_train", "rmse_train", "mae_train", "r2_test", "rmse_test", "mae_test")
ROUND_SCORES = ", ".join(f"round({c}, 8) AS {c}" for c in SCORES)
ROUND_COEFS = ", ".join(f"round({c}, 8) AS {c}" for c in ("coef_time", "coef_hour", "intercept"))

AHEAD = f"""(SELECT f.entity, step, n_total - 1 + step AS time_idx,
        CAST((start_hour + step) % 24 AS INTEGER) AS hour,
        {predicted('(n_total - 1 + step)', '((start_hour + step) % 24)')} AS price_pred
    FROM {fitted(USERS)} f
    JOIN (SELECT entity, count(*) AS n_total, arg_max(hour, time_idx) AS start_hour
        FROM {split(USERS)} GROUP BY entity) l ON f.entity = l.entity
    CROSS JOIN (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS step))"""

MODEL_REPORT = f"""(
    SELECT s.*, coef_time, coef_hour, intercept,
        CASE WHEN coef_time > 0 THEN 'NAIK' ELSE 'TURUN' END AS direction,
        CASE WHEN r2_test >= 0.7 THEN 'good' WHEN r2_test >= 0.4 THEN 'medium' ELSE 'low' END
            AS quality
    FROM {scored(USERS)} s JOIN {fitted(USERS)} m ON s.entity = m.entity)"""



def pick(column: str, texts: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{key}' THEN '{text}'" for key, text in texts.items())
    return f"CASE {column} {whens} END"


TEXT = f"""'Harga ' || r.entity || ' cenderung ' || direction || ' (koef_waktu='
    || format('{{:.4f}}', coef_time) || '). Akurasi model ' || {pick("quality", QUALITY_TEXT)}
    || ': R2_test=' || coalesce(format('{{:.4f}}', r2_test), '-') || ', RMSE_test=Rp'
    || format('{{:,}}', CAST(round_even(rmse_test, 0) AS BIGINT)) || '. '
    || {pick("direction", ADVICE_TEXT)}"""

FLOORED = f"""(SELECT entity, CASE WHEN entity = 'view' AND price < 5 THEN 5.0 ELSE price END
    AS price, ts, id FROM {EVENTS})"""

SPACE = "[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]"


def plain_text(column: str) -> str:
    """References that occur in the pages, the ampersand last so that it is decoded once."""
    text = f"coalesce({column}, '')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"),
                       ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    text = f"lower(regexp_replace({text}, '<[^>]+>', ' ', 'g'))"
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


def any_of(text: str, words: list[str], mode: str = "substring") -> str:
    space = " " if mode == "word" else ""
    return "(" + " OR ".join(f"contains({text}, '{space}{w}{space}')" for w in words) + ")"


def newest(ticks: str) -> str:
    return f"""(SELECT entity, arg_max(price, ts) AS price FROM {ticks} GROUP BY entity)"""


def deduped(entity: str) -> str:
    return f"""SELECT min(id) AS id, {entity} AS entity, price, ts
        FROM {RAW} WHERE TRY_CAST(price AS DOUBLE) > 0 GROUP BY {entity}, price, ts"""


HOURS = f"""(SELECT entity, date_trunc('hour', ts) AS period, avg(price) AS price_avg
    FROM {EVENTS} GROUP BY ALL)"""

TYPE_KEYWORDS = """(FROM (VALUES ('medium or promo', 'ediu'), ('medium or promo', 'omo'),
    ('small', 'small'), ('small', 'eaux'), ('none', 'zzz')) AS k(entity, keyword))"""

# Every entity with the changes of all ticks whose name holds one of its keywords.
NAMED_CHANGES = f"""(
    SELECT e.entity, pct FROM (SELECT DISTINCT entity FROM {TYPE_KEYWORDS}) e
    LEFT JOIN (
        SELECT lower(entity) AS name, (price - baseline) / baseline * 100 AS pct
        FROM {items('p_type')}) t
    ON EXISTS (SELECT 1 FROM {TYPE_KEYWORDS} k
        WHERE k.entity = e.entity AND contains(t.name, k.keyword)))"""

ALLOWED = f"""
SELECT id, link, source FROM (
    SELECT *, lower(regexp_extract(link, '^[^:]+://([^/?#]*)', 1)) AS host,
        lower(regexp_extract(link, '^[^:]+://[^/?#]*([^?#]*)', 1)) AS path FROM {PAGES})
WHERE CASE source
    WHEN 'com' THEN host LIKE '%example.com' AND NOT (host LIKE 'blog.%'
        OR host LIKE 'm.%' OR contains(path, '/fr/') OR contains(path, '/de/'))
    WHEN 'net' THEN host LIKE '%example.net' AND NOT (host LIKE 'www.%'
        OR contains(path, '/es/'))
    ELSE true END"""

ORACLE: dict[str, str] = {
    "silver_ticks": f"""
        SELECT {canonical('entity')} AS entity, {TYPED}, id FROM ({deduped('entity')})""",
    "silver_ticks_unified": f"""
        SELECT entity, {TYPED}, id FROM ({deduped(canonical('entity'))})""",
    "silver_news": """
        SELECT min(doc_id) AS id, text AS title, published,
            upper(arg_min(source, doc_id)) AS source, CAST(published AS TIMESTAMP) AS published_ts
        FROM (SELECT *, '2024-01-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0')
            || 'T06:30:00' AS published FROM documents)
        WHERE text <> '' GROUP BY text, published""",
    "canonical_entities": f"""
        SELECT entity AS raw_entity, {canonical('entity')} AS entity, count(*) AS n
        FROM {RAW} GROUP BY raw_entity""",
    "quality_audit": f"""
        SELECT count(*) AS rows_read, count(*) FILTER (price IS NULL) AS null_price,
            count(*) FILTER (CAST(price AS DOUBLE) <= 0) AS non_positive,
            count(*) FILTER (CAST(price AS DOUBLE) > 0)
                - count(DISTINCT (ts, entity, price)) FILTER (CAST(price AS DOUBLE) > 0)
                AS duplicates,
            count(DISTINCT (ts, entity, price)) FILTER (CAST(price AS DOUBLE) > 0) AS rows_kept
        FROM {RAW}""",
    "volatility": f"SELECT {VOLATILITY} FROM {items('p_brand')} GROUP BY entity",
    "volatility_ranked": f"""
        SELECT {VOLATILITY} FROM {USERS} WHERE price > 0 GROUP BY entity
        ORDER BY volatility_pct DESC, entity""",
    "volatility_share": f"""
        SELECT entity, price_max, price_min, round(price_avg, 8) AS price_avg, n,
            round(v, 8) AS volatility_pct, round(v / max(v) OVER () * 100, 8) AS share_pct
        FROM (SELECT entity, max(price) AS price_max, min(price) AS price_min,
                avg(price) AS price_avg, count(price) AS n,
                CASE WHEN min(price) <= 0 THEN 0.0
                    ELSE (max(price) - min(price)) / min(price) * 100 END AS v
            FROM {USERS} GROUP BY entity)""",
    "trend": f"""
        SELECT entity, date_trunc('minute', ts) AS period, round(avg(price), 8) AS price_avg
        FROM {EVENTS} GROUP BY ALL""",
    "trend_hourly": f"""
        SELECT entity, date_trunc('hour', ts) AS period, round(avg(price), 8) AS price_avg
        FROM {USERS} GROUP BY ALL""",
    "trend_matrix": f"""
        SELECT period, """ + ", ".join(
        f"round(max(price_avg) FILTER (entity = '{e}'), 8) AS {e}"
        for e in ("click", "error", "purchase", "signup", "view")
    ) + f""" FROM {HOURS}
        WHERE period IN (SELECT DISTINCT period FROM {HOURS} ORDER BY period DESC LIMIT 12)
        GROUP BY period""",
    "trend_blocks": f"""
        WITH t AS (SELECT entity, date_trunc('hour', ts) AS period, avg(price) AS price_avg
            FROM {USERS} GROUP BY ALL),
        p AS (SELECT DISTINCT period FROM t ORDER BY period DESC LIMIT 12),
        r AS (SELECT * FROM t WHERE period IN (FROM p)),
        e AS (SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS number
            FROM (SELECT DISTINCT entity FROM r))
        SELECT number // 64 AS block, CAST(number % 64 AS INTEGER) AS place, period, entity,
            round(price_avg, 8) AS price_avg
        FROM e CROSS JOIN p LEFT JOIN r USING (entity, period)""",
    "trend_filled_split": f"""
        WITH t AS (SELECT entity, date_trunc('minute', ts) AS period, avg(price) AS price_avg
            FROM {EVENTS} GROUP BY ALL),
        d AS (SELECT entity, min(price) AS baseline FROM {EVENTS} GROUP BY entity),
        grid AS (SELECT d.entity, d.baseline, p.period
            FROM d CROSS JOIN (SELECT DISTINCT period FROM t) p)
        SELECT entity, period, round(coalesce(last_value(price_avg IGNORE NULLS) OVER (
            PARTITION BY entity ORDER BY period
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), baseline), 8) AS price_avg
        FROM grid LEFT JOIN t USING (entity, period)""",
    "trend_filled": f"""
        WITH t AS (SELECT entity, date_trunc('hour', ts) AS period, avg(price) AS price_avg
            FROM {USERS} GROUP BY ALL),
        d AS (SELECT entity, min(price) AS baseline FROM {USERS} GROUP BY entity),
        grid AS (SELECT d.entity, d.baseline, p.period
            FROM d CROSS JOIN (SELECT DISTINCT period FROM t) p)
        SELECT entity, period, round(coalesce(last_value(price_avg IGNORE NULLS) OVER (
            PARTITION BY entity ORDER BY period
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), baseline), 8) AS price_avg
        FROM grid LEFT JOIN t USING (entity, period)""",
    "latest_prices": f"""
        WITH t AS (SELECT *, (price - baseline) / baseline * 100 AS pct FROM {items('l_partkey')}),
        last AS (SELECT * FROM t QUALIFY row_number() OVER (
            PARTITION BY entity ORDER BY ts DESC, id DESC, line DESC, supplier DESC) = 1),
        d AS (SELECT p_partkey AS entity, p_retailprice FROM part)
        SELECT coalesce(last.entity, d.entity) AS entity,
            coalesce(price, p_retailprice) AS price, coalesce(pct, 0.0) AS pct_change,
            CASE WHEN pct > 0.3 THEN 'up' WHEN pct < -0.3 THEN 'down' ELSE 'flat' END AS trend,
            'Nasional' AS region, ts, coalesce(baseline, p_retailprice) AS baseline
        FROM last FULL JOIN d ON last.entity = d.entity""",
    "price_changes": f"SELECT * FROM {changes(EVENTS)}",
    "price_changes_split": f"SELECT * FROM {changes(EVENTS)}",
    "alerts": f"SELECT entity, price, prev_price, pct_change, alert, ts FROM {alerts(USERS)}",
    "alert_summary": f"SELECT alert, count(*) AS n FROM {alerts(EVENTS)} GROUP BY alert",
    "pct_change_prev2": two_back("l_partkey"),
    "pct_change_prev2_split": two_back("p_brand"),
    "price_flash": f"""
        SELECT a.entity, a.price, o.price AS prev_price,
            CASE WHEN a.price > o.price THEN 'up' WHEN a.price < o.price THEN 'down' ELSE '' END
                AS flash
        FROM {newest(USERS)} a
        LEFT JOIN {newest(f"(SELECT * FROM {USERS} WHERE ts < (SELECT date_trunc('day', max(ts)) FROM events))")} o
            ON a.entity = o.entity""",
    "recent_ticks": f"SELECT * FROM {EVENTS} ORDER BY ts DESC, id DESC LIMIT 200",
    "recent_news": """
        SELECT doc_id AS id, source, text FROM documents ORDER BY doc_id DESC LIMIT 20""",
    "recent_per_entity": f"""
        SELECT * FROM {USERS}
        QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) <= 5""",
    "merged_history": """
        WITH k AS (SELECT user_id AS entity, date_trunc('hour', ts) AS ts,
            value AS price, event_id AS arrival, event_type FROM events),
        u AS (SELECT entity, ts, price, arrival, 0 AS rank, -arrival AS turn FROM k
                WHERE event_type IN ('purchase', 'signup')
            UNION ALL SELECT entity, ts, price, arrival, 1, arrival FROM k)
        SELECT entity, ts, price, arrival FROM u
        QUALIFY row_number() OVER (PARTITION BY entity, ts ORDER BY rank, turn) = 1""",
    "price_floor": f"SELECT entity, price, ts, id FROM {FLOORED}",
    "snapshot_diff": f"""
        WITH a AS (SELECT * FROM {FLOORED} WHERE entity <> 'signup'
            UNION ALL SELECT 'refund', price, ts, -id - 1 FROM {EVENTS} WHERE entity = 'purchase')
        SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.ts, b.ts) AS ts,
            coalesce(a.id, b.id) AS id, b.price AS price_before, a.price AS price_after,
            CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed'
                ELSE 'changed' END AS change
        FROM {EVENTS} b FULL JOIN a ON a.entity = b.entity AND a.ts = b.ts AND a.id = b.id
        WHERE b.id IS NULL OR a.id IS NULL OR a.price IS DISTINCT FROM b.price""",
    "news_mentions": f"""
        SELECT entity, count(DISTINCT id) AS n_news FROM {DOCS}
        JOIN {KEYWORDS} ON contains(text, keyword) GROUP BY entity""",
    "news_mentions_word": f"""
        SELECT entity, count(DISTINCT id) AS n_news FROM (SELECT id, {WORDS} AS w FROM {DOCS})
        JOIN {KEYWORDS} ON contains(w, ' ' || keyword || ' ') GROUP BY entity""",
    "price_change_by_keyword": f"""
        SELECT entity, count(pct) AS n_changes,
            round(coalesce(avg(pct), 0.0), 8) AS avg_change_pct
        FROM {NAMED_CHANGES} GROUP BY entity""",
    "keyword_correlation": f"""
        WITH n AS (SELECT entity, count(DISTINCT id) AS n_news FROM {DOCS}
            JOIN {TYPE_KEYWORDS} ON contains(text, keyword) GROUP BY entity)
        SELECT c.entity, coalesce(any_value(n_news), 0) AS n_news,
            round(coalesce(avg(pct), 0.0), 8) AS avg_change_pct
        FROM {NAMED_CHANGES} c LEFT JOIN n ON c.entity = n.entity GROUP BY c.entity""",
    "news_correlation": f"""
        WITH n AS (SELECT entity, count(DISTINCT id) AS n_news FROM {DOCS}
            JOIN {KEYWORDS} ON contains(text, keyword) GROUP BY entity),
        c AS (SELECT entity, avg(pct_change) AS chg FROM {changes(EVENTS)} GROUP BY entity)
        SELECT coalesce(n.entity, c.entity) AS entity, coalesce(n_news, 0) AS n_news,
            round(coalesce(chg, 0.0), 8) AS avg_change_pct,
            CASE WHEN chg > 0 THEN 'up' WHEN chg < 0 THEN 'down' ELSE 'flat' END AS direction,
            round(abs(coalesce(chg, 0.0)), 8) AS abs_change_pct
        FROM n FULL JOIN c ON n.entity = c.entity""",
    "relevant_docs": f"""
        SELECT doc_id AS id, source FROM documents
        WHERE {any_of(plain_text("source || ' ' || text"), ['tion', 'eaux', 'schen', 'mente'])}""",
    "relevant_docs_word": f"""
        SELECT doc_id AS id, source FROM (
            SELECT *, ' ' || trim(regexp_replace({plain_text('text')}, '[^\\p{{L}}\\p{{N}}]+', ' ',
                'g')) || ' ' AS w FROM documents)
        WHERE {any_of('w', ['tion', 'that', 'oure', 'nicht'], 'word')}""",
    "allowed_pages": ALLOWED,
    "relevant_pages": f"""
        SELECT p.id, p.link, p.source FROM {PAGES} p JOIN ({ALLOWED}) a ON p.id = a.id
        WHERE {any_of(plain_text("title || ' ' || summary"), ['tion', 'eaux', 'schen', 'mente'])}""",
    "page_plain_text": f"SELECT id, {plain_text('summary')} AS text FROM {PAGES}",
    "news_payload": f"""
        SELECT title, link, left(summary, 500) AS summary, source, left(md5(link), 12) AS key
        FROM {PAGES}""",
    "keyword_flags": f"""
        SELECT id, {any_of('text', ['tion', 'eaux', 'schen', 'mente'])} AS on_topic FROM {DOCS}""",
    "price_bands": f"""
        SELECT entity, CASE WHEN pct_change > 0.3 THEN 'up' WHEN pct_change < -0.3 THEN 'down'
            ELSE 'flat' END AS band, count(*) AS n
        FROM {changes(EVENTS)} GROUP BY ALL""",
    "ml_features": f"SELECT * FROM {features(USERS)}",
    "ml_features_split": f"SELECT * FROM {features(EVENTS)}",
    "ml_split": f"SELECT * FROM {split(USERS)}",
    "price_model": f"SELECT entity, {ROUND_COEFS} FROM {fitted(USERS)}",
    "price_model_ridge_sum": f"""
        SELECT entity, {ROUND_COEFS}
        FROM {fitted(items('l_partkey'), 'ts, id, line, supplier', 'ridge_sum')}""",
    "model_metrics": f"""
        SELECT entity, n_total, n_train, n_test, {ROUND_SCORES} FROM {scored(USERS)}""",
    "price_forecast": f"""
        SELECT entity, step, time_idx, hour, round(price_pred, 8) AS price_pred FROM {AHEAD}""",
    "model_report": f"""
        SELECT r.entity, n_total, n_train, n_test, {ROUND_SCORES}, {ROUND_COEFS}, forecast,
            direction, quality, {TEXT} AS text
        FROM {MODEL_REPORT} r JOIN (
            SELECT entity, string_agg(step || ':' || time_idx || ':' || hour, ' ' ORDER BY step)
                AS forecast
            FROM {AHEAD} GROUP BY entity) f ON r.entity = f.entity""",
    "model_leaderboard": f"""
        WITH r AS (FROM {MODEL_REPORT})
        SELECT arg_max(entity, r2_test) AS best, round(max(r2_test), 8) AS best_r2,
            arg_min(entity, r2_test) AS worst, round(min(r2_test), 8) AS worst_r2,
            count(*) FILTER (direction = 'NAIK') AS n_up,
            count(*) FILTER (direction = 'TURUN') AS n_down
        FROM r""",
    "model_directions": f"""
        WITH r AS (SELECT entity, coef_time FROM {fitted(EVENTS)})
        SELECT coalesce(string_agg(entity, ', ' ORDER BY entity) FILTER (coef_time > 0), '-') AS up,
            coalesce(string_agg(entity, ', ' ORDER BY entity) FILTER (coef_time <= 0), '-') AS down
        FROM r""",
    "model_directions_users": f"""
        WITH r AS (SELECT CAST(entity AS VARCHAR) AS entity, coef_time FROM {fitted(USERS)})
        SELECT coalesce(string_agg(entity, ', ' ORDER BY entity) FILTER (coef_time > 0), '-') AS up,
            coalesce(string_agg(entity, ', ' ORDER BY entity) FILTER (coef_time <= 0), '-') AS down
        FROM r""",
    "jsonl_ticks": f"SELECT * FROM {EVENTS}",
    "array_ticks": f"""
        SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY id) - 1 AS place
        FROM {EVENTS}""",
    "feed_items": f"""
        SELECT trim(link) AS link, make_timestamp(id * 3600000000) AS published, 'feed' AS source,
            CAST(length(trim(summary)) AS INTEGER) AS n_chars
        FROM {PAGES} WHERE id % 5 <> 0""",
    "version_history": f"""
        SELECT 0::BIGINT AS version, 'WRITE' AS operation, count(*) AS n, round(sum(price), 8) AS total FROM {EVENTS}
        UNION ALL SELECT 1, 'UPDATE', count(*), round(sum(price), 8) FROM {FLOORED}
        UNION ALL SELECT 2, 'DELETE', count(*), round(sum(price), 8) FROM {FLOORED} WHERE entity <> 'signup'""",
    "version_as_of": f"SELECT entity, price, ts, id FROM {FLOORED}",
    "price_floor_stored": f"""
        SELECT entity, CASE WHEN entity = 'click' AND CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM {EVENTS})
            THEN 0.5 ELSE price END AS price, ts, id, CAST(ts AS DATE) AS date FROM {FLOORED}""",
    "appended_batches": f"""
        SELECT entity, 'api' AS origin, 'batch ' || (id % 2) AS batch, count(*) AS n FROM {EVENTS}
        WHERE id % 2 = 0 OR entity <> 'signup' GROUP BY ALL""",
    "overwritten_table": f"SELECT *, CAST(ts AS DATE) AS date FROM {EVENTS} WHERE entity <> 'view'",
    "report_rounding": f"""
        SELECT entity, round_even(max(price), 0) AS price_max, round_even(min(price), 0) AS price_min,
            round_even(CASE WHEN min(price) <= 0 THEN 0.0
                ELSE (max(price) - min(price)) / min(price) * 100 END, 2) AS volatility_pct
        FROM {USERS} GROUP BY entity""",
    "local_hours": f"""
        SELECT CAST((hour(ts) + 7) % 24 AS INTEGER) AS hour, count(*) AS n FROM {EVENTS} GROUP BY ALL""",
    "trend_lines": f"""
        SELECT entity AS komoditas, strftime(period, '%Y-%m-%d %H:%M') AS periode,
            CAST(row_number() OVER (PARTITION BY entity ORDER BY period) AS INTEGER) AS nth
        FROM {HOURS}""",
    "stream_refresh": """
        WITH parts AS (SELECT event_id % 5 AS part, count(*) AS n FROM events GROUP BY ALL),
        least AS (SELECT (count(*) // 3) AS least FROM events),
        -- Equal parts: every second batch reaches a third of all rows.
        runs AS (SELECT unnest([1, 3]) AS upto)
        SELECT event_type AS entity, count(*) AS n FROM events JOIN runs ON event_id % 5 <= upto
        GROUP BY event_type, upto""",
    "stream_lines": f"SELECT * FROM {EVENTS}",
    "report_document": f"""
        SELECT CAST(entity AS VARCHAR) AS komoditas, CAST(NULL AS VARCHAR) AS periode,
            CAST(NULL AS DOUBLE) AS harga_rata, price_max AS harga_max,
            volatility_pct AS volatilitas_pct
        FROM (SELECT {VOLATILITY} FROM {USERS} GROUP BY entity)
        UNION ALL
        SELECT CAST(entity AS VARCHAR), strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M'),
            round(avg(price), 8), NULL, NULL
        FROM {USERS} GROUP BY entity, date_trunc('hour', ts)""",
    "report_sections": f"""
        SELECT 'volatility' AS section, count(DISTINCT entity) AS items FROM {EVENTS}
        UNION ALL SELECT 'trend', count(DISTINCT (entity, date_trunc('minute', ts))) FROM {EVENTS}
        UNION ALL SELECT 'correlation', count(DISTINCT entity) FROM (
            SELECT entity FROM {EVENTS}
            UNION ALL SELECT entity FROM {DOCS} JOIN {KEYWORDS} ON contains(text, keyword))
        UNION ALL SELECT 'models', count(DISTINCT entity) FROM {split(EVENTS)}""",
    "topic_roundtrip": f"SELECT entity AS _key, entity, price, ts, id FROM {EVENTS}",
    "stream_dedupe": "SELECT DISTINCT sha256(text) AS link FROM documents",
    "stream_ingest": f"SELECT * FROM {EVENTS}",
    "stream_view": f"SELECT * FROM {EVENTS} ORDER BY ts DESC, id DESC LIMIT 200",
    "stream_alerts": f"""
        SELECT entity, ts, id, price, prev_price, pct_change, alert FROM {alerts(USERS)}""",
    "stream_trend": f"""
        SELECT entity, date_trunc('hour', ts) AS period, round(avg(price), 8) AS price_avg,
            min(price) AS price_min, max(price) AS price_max, count(price) AS n
        FROM {EVENTS} GROUP BY ALL""",
}
ORACLE["first_available_ticks"] = ORACLE["array_ticks"]
ORACLE["news_mentions_join"] = ORACLE["news_mentions_word"]
