"""DuckDB SQL twins of :data:`pulsekit.plans.catalog.QUERIES` (same column names and types)."""

from __future__ import annotations

from pulsekit.plans.stream_catalog import STREAM_ORACLE_OF

H = 3_600_000_000
M5 = 300_000_000
S5 = 5_000_000

ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
DAY8 = "CAST(ts + INTERVAL 8 HOUR AS DATE)"


def _sliding(src: str, keys: list[str], size: int, slide: int, name: str = "cnt") -> str:
    """Window counts by copying each pane into its size/slide windows (the plain way)."""
    k = size // slide
    kc = ", ".join(keys)
    kp = (kc + ", ") if keys else ""
    return f"""
    WITH src AS ({src}),
    pc AS (SELECT {kp}us // {slide} AS p, count(*) AS c FROM src GROUP BY ALL),
    w AS (SELECT {kp}p + i AS q, c FROM pc, range(0, {k}) t(i))
    SELECT {kp}make_timestamp((q + 1) * {slide} - {size}) AS window_start,
           make_timestamp((q + 1) * {slide}) AS window_end, CAST(sum(c) AS BIGINT) AS {name}
    FROM w GROUP BY ALL"""


def _top(counts_sql: str, key: str, n: int = 3) -> str:
    return f"""
    SELECT window_end, CAST(rk AS INTEGER) AS rank, {key}, cnt FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key} ASC) AS rk
      FROM ({counts_sql}) c) WHERE rk <= {n}"""


VIEWS = f"SELECT {ITEM} AS item_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'"
HOT_ITEMS_COUNTS = _sliding(VIEWS, ["item_id"], H, M5)

GETS = ("SELECT '/item/' || CAST(" + ITEM + " AS VARCHAR) AS url, epoch_us(date_trunc('second', ts)) AS us "
        "FROM events WHERE event_type IN ('click', 'view')")

METHOD = ("CASE WHEN event_type IN ('click', 'view') THEN 'GET' "
          "WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'PUT' END")
BEHAVIOR = ("CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart' "
            "WHEN 'signup' THEN 'fav' ELSE event_type END")
HOURLY = "SELECT epoch_us(ts) AS us, user_id, event_id FROM events WHERE event_type = 'view'"

LOGIN = "SELECT user_id, ts, event_id, event_type = 'error' AS f, epoch_us(ts) AS us FROM events"
ORDERS = ("SELECT user_id, ts, event_id, event_type, epoch_us(ts) AS us FROM events "
          "WHERE event_type IN ('signup', 'purchase')")


def _runs(n: int, within_us: int) -> str:
    return f"""
    SELECT user_id, first_ts, last_ts, first_seq, last_seq, CAST({n} AS INTEGER) AS n_events FROM (
      SELECT user_id, ts AS first_ts, event_id AS first_seq, us,
        sum(CASE WHEN f THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS hits,
        lead(ts, {n - 1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_ts,
        lead(event_id, {n - 1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_seq,
        lead(us, {n - 1}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lus
      FROM ({LOGIN}) l) x
    WHERE hits = {n} AND lus - us < {within_us}"""


def _followed(within_us: int) -> str:
    return f"""
    WITH x AS (
      SELECT user_id, ts, event_id, event_type, us,
        min(CASE WHEN event_type = 'purchase' THEN {{'us': us, 'seq': event_id}} END)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx
      FROM ({ORDERS}) o)
    SELECT user_id AS order_id, ts AS first_ts, event_id AS first_seq,
           make_timestamp(nx.us) AS then_ts, nx.seq AS then_seq,
           nx IS NOT NULL AND nx.us - us < {within_us} AS hit
    FROM x WHERE event_type = 'signup'"""


def _order_status(within_us: int) -> str:
    return f"""
    WITH x AS (
      SELECT user_id, ts, event_id, event_type, us,
        lag(event_type) OVER w AS pt, lag(us) OVER w AS pus, lag(ts) OVER w AS pts,
        lag(event_id) OVER w AS pseq, lead(us) OVER w AS nus
      FROM ({ORDERS}) o WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    y AS (SELECT *, event_type = 'purchase' AND coalesce(pt = 'signup', false) AND us - pus <= {within_us} AS paid,
                 event_type = 'signup' AND (nus IS NULL OR nus - us > {within_us}) AS no_pay FROM x)
    SELECT user_id AS order_id,
      CASE WHEN paid THEN pts WHEN event_type = 'signup' THEN ts END AS create_ts,
      CASE WHEN event_type = 'purchase' THEN ts END AS pay_ts,
      CASE WHEN paid THEN pseq WHEN event_type = 'signup' THEN event_id END AS create_seq,
      CASE WHEN event_type = 'purchase' THEN event_id END AS pay_seq,
      CASE WHEN paid THEN 'paid' WHEN event_type = 'purchase' THEN 'payed_timeout' ELSE 'no_pay' END AS status
    FROM y WHERE event_type = 'purchase' OR no_pay"""


def _episodes(reach_us: int) -> str:
    """Greedy episodes, one row at a time per user, as a recursive CTE (the brute-force form)."""
    return f"""
    WITH RECURSIVE r AS (
      SELECT user_id, ts, us, f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
             count(*) OVER (PARTITION BY user_id) AS cnt
      FROM ({LOGIN}) l),
    s AS (
      SELECT user_id, rn, cnt,
        CASE WHEN f THEN us END AS t0, CASE WHEN f THEN ts END AS fts, CASE WHEN f THEN ts END AS lts,
        CASE WHEN f THEN 1 ELSE 0 END AS n,
        CAST(NULL AS TIMESTAMP) AS e_f, CAST(NULL AS TIMESTAMP) AS e_l, CAST(NULL AS BIGINT) AS e_n
      FROM r WHERE rn = 1
      UNION ALL
      SELECT r.user_id, r.rn, r.cnt,
        CASE WHEN r.f AND s.t0 IS NOT NULL AND r.us <= s.t0 + {reach_us} THEN s.t0
             WHEN r.f THEN r.us END,
        CASE WHEN r.f AND s.t0 IS NOT NULL AND r.us <= s.t0 + {reach_us} THEN s.fts
             WHEN r.f THEN r.ts END,
        CASE WHEN r.f THEN r.ts END,
        CASE WHEN r.f AND s.t0 IS NOT NULL AND r.us <= s.t0 + {reach_us} THEN s.n + 1
             WHEN r.f THEN 1 ELSE 0 END,
        CASE WHEN s.t0 IS NOT NULL AND r.us > s.t0 + {reach_us} AND s.n >= 2 THEN s.fts END,
        CASE WHEN s.t0 IS NOT NULL AND r.us > s.t0 + {reach_us} AND s.n >= 2 THEN s.lts END,
        CASE WHEN s.t0 IS NOT NULL AND r.us > s.t0 + {reach_us} AND s.n >= 2 THEN s.n END
      FROM s JOIN r ON r.user_id = s.user_id AND r.rn = s.rn + 1)
    SELECT user_id, e_f AS first_ts, e_l AS last_ts, e_n AS n_fails FROM s WHERE e_n IS NOT NULL
    UNION ALL
    SELECT user_id, fts, lts, CAST(n AS BIGINT) FROM s WHERE rn = cnt AND t0 IS NOT NULL AND n >= 2"""


def _cap(n_filter: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT user_id, event_type, ts, event_id AS seq, {DAY8} AS day,
        row_number() OVER (PARTITION BY user_id, event_type, {DAY8} ORDER BY ts, event_id) AS n
      FROM events) x WHERE {n_filter}"""


_PAIR = """
    SELECT p.user_id AS tx, p.event_id AS pay_id, p.ts AS pay_ts, r.event_id AS receipt_id, r.ts AS receipt_ts
    FROM events p JOIN events r
      ON p.user_id = r.user_id
     AND epoch_us(r.ts) BETWEEN epoch_us(p.ts) - {lo} AND epoch_us(p.ts) + {hi}
    WHERE p.event_type = 'purchase' AND r.event_type = 'signup'"""


LATE_URLS = f"""
    WITH g AS (SELECT url, us // 600 AS us, event_id FROM (
        SELECT '/item/' || CAST({ITEM} AS VARCHAR) AS url, epoch_us(date_trunc('second', ts)) AS us, event_id
        FROM events WHERE event_type IN ('click', 'view')) e),
    a AS (SELECT *, us - 20000000 + CASE WHEN event_id % 29 = 5 THEN 3600000000 WHEN event_id % 2 = 1 THEN 45000000 ELSE 0 END AS come FROM g),
    p AS (SELECT ((max(come) - min(come)) // 3 // {M5} + 1) * {M5} AS period FROM a),
    b AS (SELECT url, us, come // period AS load FROM a, p),
    m AS (SELECT load, (max(max(us)) OVER (ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 - 2000) * 1000 AS mark
          FROM b GROUP BY load),
    w AS (SELECT url, (us // {M5} + 1 + j) * {M5} AS e, (us // {M5} + 2) * {M5} AS last, coalesce(mark, 0) AS mark, j
          FROM b JOIN m USING (load), range(0, 2) t(j))
    SELECT url, make_timestamp(e) AS window_end, count(*) FILTER (e + 60000000 > mark) AS cnt,
           CAST(greatest(count(*) FILTER (e <= mark AND e + 60000000 > mark)
                - CASE WHEN count(*) FILTER (e > mark) = 0 THEN 1 ELSE 0 END, 0) AS INTEGER) AS corrections,
           CAST(count(*) FILTER (e = last AND e + 60000000 <= mark) AS BIGINT) AS dropped
    FROM w GROUP BY url, e HAVING count(*) FILTER (e + 60000000 > mark OR e = last) > 0"""


def _one_to_one(low: int, high: int) -> str:
    """A row at a time per user, with the list of those that wait (the brute-force form)."""
    return f"""
    WITH RECURSIVE r AS (
      SELECT user_id, ts, epoch_us(ts) AS us, event_id AS id, event_type = 'purchase' AS pay,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type IN ('purchase', 'signup')),
    s AS (
      SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(us BIGINT, id BIGINT, pay BOOLEAN)[]) AS wait,
             CAST(NULL AS BIGINT) AS pay_id, CAST(NULL AS BIGINT) AS receipt_id FROM r GROUP BY user_id
      UNION ALL
      SELECT user_id, rn, CASE WHEN hit IS NULL THEN list_append(wait, {{'us': us, 'id': id, 'pay': pay}})
                               ELSE list_filter(wait, lambda x: x.id <> hit.id) END,
             CASE WHEN hit IS NOT NULL THEN CASE WHEN pay THEN id ELSE hit.id END END,
             CASE WHEN hit IS NOT NULL THEN CASE WHEN pay THEN hit.id ELSE id END END
      FROM (SELECT r.user_id, r.rn, r.us, r.id, r.pay, s.wait,
              list_filter(s.wait, lambda x: x.pay <> r.pay AND (CASE WHEN r.pay THEN x.us - r.us ELSE r.us - x.us END) BETWEEN {low} AND {high})[1] AS hit
            FROM s JOIN r ON r.user_id = s.user_id AND r.rn = s.rn + 1) q),
    m AS (SELECT pay_id, receipt_id FROM s WHERE pay_id IS NOT NULL),
    p AS (SELECT user_id, id AS pay_id, ts AS pay_ts FROM r WHERE pay),
    c AS (SELECT user_id, id AS receipt_id, ts AS receipt_ts FROM r WHERE NOT pay)
    SELECT coalesce(p.user_id, c.user_id) AS tx, p.pay_id, pay_ts, c.receipt_id, receipt_ts,
           CASE WHEN m.pay_id IS NOT NULL THEN 'matched' WHEN p.pay_id IS NULL THEN 'receipt_only' ELSE 'pay_only' END AS status
    FROM p LEFT JOIN m ON m.pay_id = p.pay_id FULL JOIN c ON c.receipt_id = m.receipt_id"""


def build(cap: int = 3, top_n: int = 3) -> dict[str, str]:
    pair = _PAIR.format(lo=3 * H, hi=5 * H)
    pass_n = max(1, cap - 1)
    warn_n = max(2, cap)
    clicks = f"""
      SELECT e.user_id, {ITEM} AS ad_id, n.n_name AS province, e.ts, e.event_id
      FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
                    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
      WHERE e.event_type = 'click'"""
    passed_clicks = f"""
      SELECT province, epoch_us(ts) AS us FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, {DAY8} ORDER BY ts, event_id) AS n
        FROM ({clicks}) c) x WHERE n <= {pass_n}"""
    market = f"""
      SELECT ['app store', 'wechat', 'weibo', 'tieba'][(({ITEM} % 4) + 4) % 4 + 1] AS channel,
             upper(event_type) AS behavior, epoch_us(ts) AS us FROM events"""
    return {
        "hot_items_counts": HOT_ITEMS_COUNTS,
        "hot_items_topn": _top(HOT_ITEMS_COUNTS, "item_id", top_n),
        "log_parse": f"""
            SELECT event_id AS seq,
                   format('10.{{}}.{{}}.{{}}', (user_id // 65536) % 256, (user_id // 256) % 256, user_id % 256) AS ip,
                   CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
                   {METHOD} AS method, '/item/' || CAST({ITEM} AS VARCHAR) AS url
            FROM events""",
        "hot_urls_topn": _top(_sliding(GETS, ["url"], 2 * M5, M5), "url", top_n),
        "csv_parse": f"""
            SELECT event_id AS seq, user_id, {ITEM} AS item_id, CAST((({ITEM} % 10) + 10) % 10 AS INTEGER) AS category_id,
                   {BEHAVIOR} AS behavior, date_trunc('second', ts) AS ts
            FROM events""",
        "pv_hourly": _sliding(HOURLY, [], H, H, "pv"),
        "pv_salted": _sliding(HOURLY, [], H, H, "pv"),
        "uv_hourly": f"""
            SELECT make_timestamp(us // {H} * {H}) AS window_start, make_timestamp((us // {H} + 1) * {H}) AS window_end,
                   count(DISTINCT user_id) AS uv FROM ({HOURLY}) v GROUP BY ALL""",
        "uv_bitmap": f"""
            SELECT make_timestamp(us // {H} * {H}) AS window_start, make_timestamp((us // {H} + 1) * {H}) AS window_end,
                   count(DISTINCT right(CAST(user_id + 1000000 * (1 + us // {M5} % 9) AS VARCHAR), 6)) AS uv,
                   count(DISTINCT user_id + 1000000 * (1 + us // {M5} % 9)) AS ids FROM ({HOURLY}) v GROUP BY ALL""",
        "uv_bitmap_sliding": f"""
            WITH v AS (SELECT us // {H} AS p, right(CAST(user_id + 1000000 * (1 + us // {M5} % 9) AS VARCHAR), 6) AS off FROM ({HOURLY}) h)
            SELECT make_timestamp((p - i) * {H}) AS window_start, make_timestamp((p - i + n) * {H}) AS window_end,
                   count(DISTINCT off) AS uv, CAST(n AS INTEGER) AS hours
            FROM v, (VALUES (1), (24)) s(n), range(0, 24) t(i) WHERE i < n GROUP BY p - i, n""",
        "uv_approx": f"""
            SELECT make_timestamp(us // {H} * {H}) AS window_start, make_timestamp((us // {H} + 1) * {H}) AS window_end,
                   count(DISTINCT user_id) AS uv, true AS close FROM ({HOURLY}) v GROUP BY ALL""",
        "uv_running": f"""
            WITH v AS (SELECT event_id AS seq, user_id, us, us // {H} AS q FROM ({HOURLY}) h),
            f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY q, user_id ORDER BY us, seq) = 1
                                 THEN 1 ELSE 0 END AS fst FROM v)
            SELECT seq, make_timestamp(q * {H}) AS window_start, make_timestamp((q + 1) * {H}) AS window_end,
                   CAST(sum(fst) OVER (PARTITION BY q ORDER BY us, seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv
            FROM f""",
        "channel_counts": _sliding(market, ["channel", "behavior"], H, S5),
        "click_cap_pass": f"SELECT user_id, event_type, ts, seq, day FROM ({_cap(f'n <= {pass_n}')}) c",
        "click_cap_warn": f"""SELECT user_id, event_type, day, ts, seq,
            'blacklisted: daily click cap reached' AS warning FROM ({_cap(f'n = {warn_n}')}) c""",
        "click_cap_tagged": f"""SELECT user_id, event_type, ts, seq, day, CASE WHEN n <= {pass_n} THEN 'pass' ELSE 'warn' END AS status
            FROM ({_cap(f'n <= {pass_n} OR n = {warn_n}')}) c""",
        "order_pattern_tagged": f"""SELECT order_id, first_ts, first_seq, CASE WHEN hit THEN then_ts END AS then_ts, CASE WHEN hit THEN then_seq END AS then_seq,
            CASE WHEN hit THEN 'match' ELSE 'timeout' END AS status FROM ({_followed(12 * H)}) m""",
        "csv_rejects_tagged": f"""
            WITH v AS (SELECT event_id AS seq, user_id, {ITEM} AS item_id, CAST((({ITEM} % 10) + 10) % 10 AS INTEGER) AS category_id, {BEHAVIOR} AS behavior,
                              epoch_us(ts) // 1000000 AS sec FROM events),
            l AS (SELECT *, seq % 17 = 0 AS short, seq % 19 = 0 AS text FROM v)
            SELECT seq, CASE WHEN short THEN concat_ws(',', user_id, item_id, category_id)
                             WHEN text THEN concat_ws(',', 'x' || user_id, item_id, category_id, behavior, sec) END AS line,
                   CASE WHEN NOT (short OR text) THEN user_id END AS user_id, CASE WHEN NOT (short OR text) THEN item_id END AS item_id,
                   CASE WHEN NOT (short OR text) THEN category_id END AS category_id, CASE WHEN NOT (short OR text) THEN behavior END AS behavior,
                   CASE WHEN short OR text THEN 'reject' ELSE 'ok' END AS status FROM l""",
        "ad_province_counts": _sliding(passed_clicks, ["province"], H, S5),
        "fail_pairs": f"""
            SELECT user_id, first_ts, last_ts, first_seq, last_seq FROM (
              SELECT user_id, ts AS last_ts, event_id AS last_seq, f, us,
                lag(f) OVER w AS pf, lag(us) OVER w AS pus, lag(ts) OVER w AS first_ts, lag(event_id) OVER w AS first_seq
              FROM ({LOGIN}) l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x
            WHERE f AND pf AND abs(us - pus) <= {2 * H}""",
        "fail_pairs_arrival": f"""
            SELECT user_id, first_ts, last_ts, first_seq, last_seq FROM (
              SELECT user_id, ts AS last_ts, event_id AS last_seq, f, us,
                lag(f) OVER w AS pf, lag(us) OVER w AS pus, lag(ts) OVER w AS first_ts, lag(event_id) OVER w AS first_seq
              FROM (SELECT * REPLACE (event_id // 7 * 7 + 6 - event_id % 7 AS event_id) FROM ({LOGIN}) r) l
              WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) x
            WHERE f AND pf AND abs(us - pus) <= {2 * H}""",
        "fail_episodes": _episodes(2 * H),
        "fail_runs": _runs(3, 24 * H),
        "fail_next": _runs(2, 6 * H),
        "order_paid": f"SELECT order_id, first_ts, first_seq, then_ts, then_seq FROM ({_followed(12 * H)}) m WHERE hit",
        "order_timeout": f"SELECT order_id, first_ts, first_seq FROM ({_followed(12 * H)}) m WHERE NOT hit",
        "order_status": _order_status(12 * H),
        "interval_join": pair,
        "read_ad_clicks": f"""SELECT e.user_id, {ITEM} AS ad_id, n.n_name AS province, c.c_mktsegment AS city, date_trunc('second', e.ts) AS ts
            FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE e.event_type = 'click'""",
        "read_logins": """SELECT user_id, '10.0.0.' || (user_id % 256) AS ip, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type,
            date_trunc('second', ts) AS ts FROM events""",
        "read_orders": """SELECT user_id AS order_id, CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS event_type,
            CASE event_type WHEN 'purchase' THEN 'tx' || user_id END AS tx_id, date_trunc('second', ts) AS ts
            FROM events WHERE event_type IN ('signup', 'purchase')""",
        "read_receipts": f"""SELECT 'tx' || user_id AS tx_id, ['wechat', 'alipay'][(({ITEM} % 2) + 2) % 2 + 1] AS pay_channel, date_trunc('second', ts) AS ts
            FROM events WHERE event_type = 'signup'""",
        "read_market": f"""SELECT user_id, upper(event_type) AS behavior, ['app store', 'wechat', 'weibo', 'tieba'][(({ITEM} % 4) + 4) % 4 + 1] AS channel,
            date_trunc('millisecond', ts) AS ts FROM events""",
        "hot_items_text": f"""SELECT window_end, '====' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0====' || chr(10)
                || string_agg('Top' || rank || ' ItemId:' || item_id || ' Count:' || cnt, chr(10) ORDER BY rank) AS text
            FROM ({_top(HOT_ITEMS_COUNTS, "item_id", top_n)}) t GROUP BY window_end""",
        "reconcile_one_to_one": _one_to_one(-3 * H, 5 * H),
        "reconcile": f"""
            WITH m AS ({pair}),
            p AS (SELECT user_id AS tx, event_id AS pay_id, ts AS pay_ts FROM events WHERE event_type = 'purchase'),
            r AS (SELECT user_id AS tx, event_id AS receipt_id, ts AS receipt_ts FROM events WHERE event_type = 'signup')
            SELECT tx, pay_id, pay_ts, receipt_id, receipt_ts, 'matched' AS status FROM m
            UNION ALL
            SELECT tx, pay_id, pay_ts, NULL, NULL, 'pay_only' FROM p WHERE pay_id NOT IN (SELECT pay_id FROM m)
            UNION ALL
            SELECT tx, NULL, NULL, receipt_id, receipt_ts, 'receipt_only' FROM r
            WHERE receipt_id NOT IN (SELECT receipt_id FROM m)""",
    }


ORACLES = build()
ORACLES["stream_hot_urls_late"] = LATE_URLS
ORACLES["stream_login_disorder"] = """
    SELECT user_id, first_ts, last_ts, first_seq, last_seq FROM (
      SELECT user_id, make_timestamp(us) AS last_ts, event_id AS last_seq, f, us,
        lag(f) OVER w AS pf, lag(us) OVER w AS pus, make_timestamp(lag(us) OVER w) AS first_ts, lag(event_id) OVER w AS first_seq
      FROM (SELECT user_id, event_id, event_type = 'error' AS f, epoch_us(ts) // 600 AS us FROM events) l
      WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)) x
    WHERE f AND pf AND abs(us - pus) <= 12000000"""
ORACLES["stream_pv_upsert"] = ORACLES["pv_hourly"]
ORACLES["stream_channel_ingest"] = f"""
    SELECT ['app store', 'wechat', 'weibo', 'tieba'][(({ITEM} % 4) + 4) % 4 + 1] AS channel, upper(event_type) AS behavior,
           count(*) AS cnt, true AS replayed FROM events GROUP BY ALL"""
ORACLES.update({stream: ORACLES[batch] for stream, batch in STREAM_ORACLE_OF.items()})
