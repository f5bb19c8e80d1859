"""One SQL text per named query."""

from __future__ import annotations

import math

from oracle.hashing import hash_int, hashed
from oracle.logs import LOGS

ORACLE: dict[str, str] = {}


def add(name: str, body: str, doubles: str = "", texts: str = "", ctes: str = "") -> None:
    """Register a query; ``doubles`` are rounded and ``texts`` (dates, times) written as text."""
    replaced = [
        f"CASE WHEN round({c}, 6) = 0 THEN 0.0::DOUBLE ELSE round({c}, 6) END AS {c}"
        for c in doubles.split()
    ] + [f"CAST({c} AS VARCHAR) AS {c}" for c in texts.split()]
    star = f"* REPLACE ({', '.join(replaced)})" if replaced else "*"
    more = f", {ctes}" if ctes else ""
    ORACLE[name] = f"WITH {LOGS}{more} SELECT {star} FROM ({body})"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


LIKES = "count(*) FILTER (WHERE action = 'like')"
VIEWS = "count(*) FILTER (WHERE action = 'view')"
MESSAGES = "count(*) FILTER (WHERE action = 'message')"
YESTERDAY = "date = DATE '2024-01-30'"
WEEK = "date >= DATE '2024-01-24'"
SINCE = "DATE '2024-01-10'"

# --- sources ---------------------------------------------------------------

_ROW = "user_id, post_id, time, action, age, os, gender, country, city, source, exp_group"
add("feed_peek", f"SELECT {_ROW} FROM feed ORDER BY time, user_id, post_id, action LIMIT 5", texts="time")
add("activity_union", "SELECT * EXCLUDE (date) FROM act", texts="time")

# --- daily metrics ---------------------------------------------------------


def _feed_daily(where: str, digits: int) -> str:
    return f"""SELECT date, count(DISTINCT user_id) AS dau, {VIEWS} AS views, {LIKES} AS likes,
        round({div(LIKES, VIEWS)}, {digits}) AS ctr FROM feed WHERE {where} GROUP BY date"""


add("feed_yesterday", _feed_daily(YESTERDAY, 2), "ctr", "date")
add("feed_last7", _feed_daily(f"{WEEK} AND date <= DATE '2024-01-30'", 4), "ctr", "date")


def _dau(where: str) -> str:
    return f"""SELECT t.date, t.n AS dau_app, coalesce(m.n, 0) AS dau_messenger, coalesce(f.n, 0) AS dau_feed
      FROM (SELECT date, count(DISTINCT user_id) AS n FROM act WHERE {where} GROUP BY date) t
      LEFT JOIN (SELECT date, count(DISTINCT user_id) AS n FROM msg WHERE {where} GROUP BY date) m USING (date)
      LEFT JOIN (SELECT date, count(DISTINCT user_id) AS n FROM feed WHERE {where} GROUP BY date) f USING (date)"""


add("feed_last7_log", _feed_daily(f"{WEEK} AND date <= DATE '2024-01-30'", 4), "ctr", "date")
add("app_dau_week_log", _dau(WEEK), texts="date")
add("app_dau_yesterday", _dau(YESTERDAY), texts="date")
add("app_dau_week", _dau(WEEK), texts="date")
add(
    "app_dau_long",
    f"""SELECT date, variable, CAST(value AS DOUBLE) AS value FROM ({_dau(WEEK)})
        UNPIVOT (value FOR variable IN (dau_app, dau_messenger, dau_feed))""",
    "value",
    "date",
)
_TOTALS = f"SELECT date, {LIKES} AS likes, {VIEWS} AS views, {MESSAGES} AS messages FROM act WHERE {YESTERDAY} GROUP BY date"
add("action_totals", _TOTALS, texts="date")


def _per_user(action: str) -> str:
    return div(
        f"count(*) FILTER (WHERE action = '{action}')",
        f"count(DISTINCT user_id) FILTER (WHERE action = '{action}')",
    )


add(
    "actions_per_user",
    f"""SELECT date, {_per_user('like')} AS likes_per_user, {_per_user('view')} AS views_per_user,
        {_per_user('message')} AS messages_per_user FROM act WHERE {WEEK} GROUP BY date""",
    "likes_per_user views_per_user messages_per_user",
    "date",
)


def _overlap(keys: list[str]) -> str:
    cols = ", ".join(keys)
    lead = f"{cols}, " if keys else ""
    both = ", ".join([*keys, "user_id"])
    return f"""
      SELECT {lead}'both' AS segment, count(*) AS users FROM
        (SELECT DISTINCT {both} FROM feed INTERSECT SELECT DISTINCT {both} FROM msg) {'GROUP BY ' + cols if keys else ''}
      UNION ALL SELECT {lead}'feed_only', count(*) FROM
        (SELECT DISTINCT {both} FROM feed EXCEPT SELECT DISTINCT {both} FROM msg) {'GROUP BY ' + cols if keys else ''}
      UNION ALL SELECT {lead}'messenger_only', count(*) FROM
        (SELECT DISTINCT {both} FROM msg EXCEPT SELECT DISTINCT {both} FROM feed) {'GROUP BY ' + cols if keys else ''}"""


add("audience_overlap", _overlap(["date"]), texts="date")
add("audience_overlap_total", f"SELECT * FROM ({_overlap([])}) WHERE users > 0")
add(
    "feed_by_slice",
    " UNION ALL ".join(
        f"""SELECT date, '{c}' AS dimension, CAST({c} AS VARCHAR) AS dimension_value,
            count(DISTINCT user_id) AS dau, {VIEWS} AS views, {LIKES} AS likes,
            {div(LIKES, VIEWS)} AS ctr FROM feed GROUP BY date, {c}"""
        for c in ["os", "gender", "age", "country", "city", "source"]
    ),
    "ctr",
    "date",
)
SLOT = "time_bucket(INTERVAL 15 MINUTE, time)"
add(
    "feed_today",
    f"""SELECT {SLOT} AS ts, count(DISTINCT user_id) AS users, {VIEWS} AS views, {LIKES} AS likes,
        {div(LIKES, VIEWS)} AS ctr FROM feed
        WHERE time >= TIMESTAMP '2024-01-30 00:00:00' AND time < TIMESTAMP '2024-01-30 23:50:00' GROUP BY 1""",
    "ctr",
    "ts",
)
add(
    "feed_report",
    f"""SELECT date, 'Feed report for ' || CAST(date AS VARCHAR) || ':' || chr(10) || 'DAU = ' || dau
        || chr(10) || 'views = ' || views || chr(10) || 'likes = ' || likes
        || chr(10) || 'CTR = ' || coalesce(format('{{:.2f}}', ctr), 'n/a') AS text
        FROM ({_feed_daily(YESTERDAY, 2)})""",
    texts="date",
)
add(
    "app_report",
    f"""SELECT date, 'App report for ' || CAST(date AS VARCHAR) || '.' || chr(10) || chr(10) || 'DAU:'
        || chr(10) || 'DAU_app = ' || dau_app || chr(10) || 'DAU_messenger = ' || dau_messenger
        || chr(10) || 'DAU_feed = ' || dau_feed || chr(10) || chr(10) || 'User activity:'
        || chr(10) || 'likes = ' || likes || chr(10) || 'views = ' || views
        || chr(10) || 'messages = ' || messages AS text
        FROM ({_dau(YESTERDAY)}) JOIN ({_TOTALS}) USING (date)""",
    texts="date",
)
add("feed_dau", "SELECT date, count(DISTINCT user_id) AS dau FROM feed GROUP BY date", texts="date")
add(
    "posts_viewed_daily",
    "SELECT date, count(DISTINCT post_id) AS posts FROM feed WHERE action = 'view' GROUP BY date",
    texts="date",
)

# --- retention and audience ------------------------------------------------


def _retention(log: str, by: str = "") -> str:
    lead = f"t1.{by}, " if by else ""
    first = f", {_first(by)}" if by else ""
    return f"""SELECT {lead}start_date, date, count(*) AS active_users
      FROM (SELECT user_id{first}, min(date) AS start_date FROM {log} GROUP BY user_id
            HAVING min(date) >= {SINCE}) t1
      JOIN (SELECT DISTINCT user_id, date FROM {log}) t2 ON t1.user_id = t2.user_id
      GROUP BY {lead}start_date, date"""


def _first(by: str) -> str:
    """The value at the user's first action."""
    return f"min(struct_pack(t := time, v := {by})).v AS {by}"


add(
    "first_seen",
    f"SELECT user_id, min(date) AS start_date FROM feed GROUP BY user_id HAVING min(date) >= {SINCE}",
    texts="start_date",
)
add("retention_feed", _retention("feed"), texts="start_date date")
add("retention_messenger", _retention("msg"), texts="start_date date")
_DATES = [f"2024-01-{d:02d}" for d in range(10, 32)]


def _matrix(log: str) -> str:
    cells = ", ".join(f"max(active_users) FILTER (WHERE date = DATE '{d}') AS \"{d}\"" for d in _DATES)
    return f"SELECT start_date, {cells} FROM ({_retention(log)}) GROUP BY start_date"


add("retention_matrix", _matrix("feed"), texts="start_date")
_RATES = f"""SELECT c.source, c.start_date, c.date, c.active_users, c.date - c.start_date AS day_number,
    z.active_users AS cohort_size, {div('c.active_users', 'z.active_users')} AS rate
    FROM ({_retention("feed", "source")}) c JOIN ({_retention("feed", "source")}) z
    ON z.source = c.source AND z.start_date = c.start_date AND z.date = c.start_date"""
add(
    "retention_by_source",
    f"SELECT * REPLACE (CAST(day_number AS INTEGER) AS day_number) FROM ({_RATES})",
    "rate",
    "start_date date",
)
add(
    "retention_mean",
    f"""SELECT source, CAST(day_number AS INTEGER) AS day_number, avg(rate) AS mean_rate, count(*) AS cells
        FROM ({_RATES}) GROUP BY source, day_number
        UNION ALL SELECT source, NULL, avg(rate), count(*) FROM ({_RATES}) GROUP BY source""",
    "mean_rate",
)
add(
    "campaign_cohort",
    f"""SELECT start_date, source, count(*) AS new_users, count(back) AS returned_next_day,
        {div('count(back)', 'count(*)')} AS return_rate
        FROM (SELECT user_id, {_first('source')}, min(date) AS start_date FROM feed GROUP BY user_id) t1
        LEFT JOIN (SELECT DISTINCT user_id AS back, date FROM feed) t2
        ON back = t1.user_id AND t2.date = start_date + 1 GROUP BY start_date, source""",
    "return_rate",
    "start_date",
)
_BEFORE, _ON = "DATE '2024-01-19'", "DATE '2024-01-20'"


def _change(dim: str, value: str) -> str:
    return f"""SELECT '{dim}' AS dimension, {value} AS dimension_value,
        count(DISTINCT CASE WHEN date = {_BEFORE} THEN user_id END) AS users_before,
        count(DISTINCT CASE WHEN date = {_ON} THEN user_id END) AS users_on
        FROM feed WHERE date IN ({_BEFORE}, {_ON}) GROUP BY 1, 2"""


add(
    "dau_change_by_dim",
    f"""SELECT c.*, c.users_on - c.users_before AS change,
        {div('c.users_on - c.users_before', '(SELECT users_on - users_before FROM total)')} AS share_of_change,
        CAST(row_number() OVER (PARTITION BY c.dimension
             ORDER BY c.users_on - c.users_before, c.dimension_value) AS INTEGER) AS drop_rank
        FROM ({' UNION ALL '.join(_change(c, f'CAST({c} AS VARCHAR)') for c in ["country", "city", "os", "gender", "source"])}) c""",
    "share_of_change",
    ctes=f"total AS ({_change('all', chr(39) + 'all' + chr(39))})",
)


def _weekly(log: str) -> str:
    visits = f"(SELECT DISTINCT user_id, CAST(date_trunc('week', date) AS DATE) AS week FROM {log})"
    return f"""
      SELECT v.week AS this_week, CAST(v.week - 7 AS DATE) AS previous_week,
             CASE WHEN p.user_id IS NULL THEN 'new' ELSE 'retained' END AS status, count(*) AS num_users
      FROM {visits} v LEFT JOIN {visits} p ON p.user_id = v.user_id AND p.week = v.week - 7
      GROUP BY 1, 2, 3
      UNION ALL
      SELECT CAST(v.week + 7 AS DATE), v.week, 'lost', -count(*)
      FROM {visits} v LEFT JOIN {visits} n ON n.user_id = v.user_id AND n.week = v.week + 7
      WHERE n.user_id IS NULL AND v.week + 7 <> DATE '2024-02-05' GROUP BY 1, 2, 3"""


add("weekly_audience_feed", _weekly("feed"), texts="this_week previous_week")
add("weekly_audience_messenger", _weekly("msg"), texts="this_week previous_week")
# sketches of days hold these numbers of users exactly
for _sketch in ("audience_overlap", "audience_overlap_total", "weekly_audience_feed", "weekly_audience_messenger"):
    ORACLE[f"{_sketch}_sketch"] = ORACLE[_sketch]
_CUTS = ["os", "gender", "age", "country", "city", "source"]
add(
    "uniq_week_check",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS dimension, {f"CAST({c} AS VARCHAR)" if c != "all" else "'all'"} AS dimension_value,
            count(DISTINCT user_id) AS users, true AS estimate_is_near
            FROM feed WHERE {WEEK} AND date <= DATE '2024-01-30' GROUP BY 2"""
        for c in ["all", *_CUTS]
    ),
)
# a state of users, merged day by day, must give what the whole log gives
for _state, _whole in {
    "state_first_seen": "first_seen",
    "state_retention": "retention_feed",
    "state_weekly_audience": "weekly_audience_feed",
    "state_campaign_cohort": "campaign_cohort",
    "state_dau": "feed_dau",
}.items():
    ORACLE[_state] = ORACLE[_whole]


def _weekly_matrix(log: str) -> str:
    cells = ", ".join(f"max(num_users) FILTER (WHERE status = '{s}') AS {s}" for s in ("new", "retained", "lost"))
    return f"SELECT CAST(this_week AS VARCHAR) AS this_week, {cells} FROM ({_weekly(log)}) GROUP BY 1"


add("weekly_matrix", _weekly_matrix("feed"))
_APP_TABLES = {
    "app_report_dau": (
        f"""SELECT date, variable, CAST(value AS DOUBLE) AS value FROM ({_dau(WEEK)})
            UNPIVOT (value FOR variable IN (dau_app, dau_messenger, dau_feed))""", "value", "date"),
    "app_report_actions_per_user": (
        f"""SELECT date, v AS variable, CASE v WHEN 'likes_per_user' THEN {_per_user('like')}
            WHEN 'views_per_user' THEN {_per_user('view')} ELSE {_per_user('message')} END AS value
            FROM act, (VALUES ('likes_per_user'), ('views_per_user'), ('messages_per_user')) t(v)
            WHERE {WEEK} GROUP BY date, v""", "value", "date"),
    "app_report_weekly_feed": (_weekly_matrix("feed"), "", ""),
    "app_report_weekly_messenger": (_weekly_matrix("msg"), "", ""),
    "app_report_retention_feed": (_matrix("feed"), "", "start_date"),
    "app_report_retention_messenger": (_matrix("msg"), "", "start_date"),
}
for _name, (_body, _doubles, _texts) in _APP_TABLES.items():
    add(_name, _body, _doubles, _texts)

# --- daily mart ------------------------------------------------------------

_COUNTS = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]
_MART = f"""
fud AS (SELECT user_id, date AS event_date, {VIEWS} AS views, {LIKES} AS likes,
        max(gender) AS gender, max(age) AS age, max(os) AS os FROM feed GROUP BY user_id, date),
sud AS (SELECT user_id, date AS event_date, count(receiver_id) AS messages_sent,
        count(DISTINCT receiver_id) AS users_sent, max(gender) AS gender, max(age) AS age, max(os) AS os
        FROM msg GROUP BY user_id, date),
rud AS (SELECT receiver_id AS user_id, date AS event_date, count(user_id) AS messages_received,
        count(DISTINCT user_id) AS users_received FROM msg GROUP BY receiver_id, date),
mud AS (SELECT coalesce(sud.user_id, rud.user_id) AS user_id, coalesce(sud.event_date, rud.event_date) AS event_date,
        coalesce(messages_sent, 0) AS messages_sent, coalesce(users_sent, 0) AS users_sent,
        coalesce(messages_received, 0) AS messages_received, coalesce(users_received, 0) AS users_received,
        gender, age, os
        FROM sud FULL JOIN rud ON sud.user_id = rud.user_id AND sud.event_date = rud.event_date),
ud AS (SELECT coalesce(fud.user_id, mud.user_id) AS user_id, coalesce(fud.event_date, mud.event_date) AS event_date,
       CASE coalesce(fud.gender, mud.gender) WHEN 1 THEN 'male' WHEN 0 THEN 'female' END AS gender,
       coalesce(fud.age, mud.age) AS age, coalesce(fud.os, mud.os) AS os,
       {', '.join(f'coalesce({c}, 0) AS {c}' for c in _COUNTS)}
       FROM fud FULL JOIN mud ON fud.user_id = mud.user_id AND fud.event_date = mud.event_date)"""


def _cut(dim: str) -> str:
    return f"""SELECT event_date, '{dim}' AS dimension, coalesce(CAST({dim} AS VARCHAR), 'unknown') AS dimension_value,
        {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _COUNTS)} FROM ud GROUP BY 1, 2, 3"""


for _name, _table in [
    ("feed_user_day", "fud"), ("sent_user_day", "sud"), ("received_user_day", "rud"),
    ("messenger_user_day", "mud"), ("user_day", "ud"),
]:
    add(_name, f"SELECT * FROM {_table}", texts="event_date", ctes=_MART)
for _dim in ["gender", "age", "os"]:
    add(f"mart_{_dim}", _cut(_dim), texts="event_date", ctes=_MART)
for _name in ["daily_mart", "daily_mart_log", "mart_roundtrip"]:
    add(
        _name,
        " UNION ALL ".join(_cut(d) for d in ["gender", "os", "age"]),
        texts="event_date",
        ctes=_MART,
    )

# --- experiments -----------------------------------------------------------

_AB = "date BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'"
_AA = "date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"


def _users(where: str, groups: str) -> str:
    return f"""u AS (SELECT exp_group, user_id, {LIKES} AS likes, {VIEWS} AS views,
        {div(LIKES, VIEWS)} AS ctr FROM feed WHERE {where} AND exp_group IN ({groups}) GROUP BY exp_group, user_id)"""


_AB_USERS, _AB_ALL, _AA_USERS = _users(_AB, "1, 2"), _users(_AB, "0, 1, 2, 3"), _users(_AA, "2, 3")


def _md5(salt: str, n: int) -> str:
    return f"CAST(('0x' || substr(md5('{salt}:' || CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % {n} AS INTEGER)"


add(
    "split_balance",
    f"SELECT {_md5('split', 4)} AS split_group, count(*) AS users FROM (SELECT DISTINCT user_id FROM feed) GROUP BY 1",
)
add("user_ctr", "SELECT * FROM u", "ctr", ctes=_AB_ALL)
add(
    "group_sizes",
    "SELECT exp_group, count(*) AS users, count(ctr) AS with_ctr FROM u GROUP BY exp_group",
    ctes=_AA_USERS,
)


def _p_of_t(source: str, key: str) -> str:
    """Two-sided p of t by numerical integration of the density in the angle atan(t / sqrt(dof))."""
    return f"""SELECT {key}, 1 - (step / 3 * area) / (sqrt(pi()) / 2 * exp(lgamma(dof / 2) - lgamma((dof + 1) / 2))) AS p_value
      FROM (SELECT {key}, any_value(dof) AS dof, any_value(angle) / 2000 AS step,
              sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                  * pow(cos(angle * i / 2000), dof - 1)) AS area
            FROM (SELECT {key}, dof, atan(abs(t) / sqrt(dof)) AS angle FROM {source} WHERE t IS NOT NULL),
                 range(2001) r(i) GROUP BY {key})"""


def _moments(metric: str, a: str, b: str) -> str:
    return ", ".join(
        f"""count({metric}) FILTER (WHERE {cond}) AS n_{g}, avg({metric}) FILTER (WHERE {cond}) AS mean_{g},
            var_samp({metric}) FILTER (WHERE {cond}) AS var_{g}"""
        for g, cond in (("a", a), ("b", b))
    )


_T = f"""mean_a - mean_b AS diff,
  CASE WHEN n_a > 1 AND n_b > 1 THEN {div('(mean_a - mean_b)', 'sqrt(var_a / n_a + var_b / n_b)')} END AS t,
  CASE WHEN n_a > 1 AND n_b > 1 THEN {div('pow(var_a / n_a + var_b / n_b, 2)', '(pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1))')} END AS dof"""
_WELCH_DOUBLES = "mean_a var_a mean_b var_b diff t dof p_value"


def _welch(table: str, metric: str, a: int, b: int) -> str:
    return f"""tests AS (SELECT 1 AS id, *, {_T} FROM (SELECT {_moments(metric, f'exp_group = {a}', f'exp_group = {b}')},
        count(*) FILTER (WHERE {metric} IS NULL) AS n_excluded FROM {table} WHERE exp_group IN ({a}, {b})))"""


def add_welch(name: str, ctes: str, table: str, metric: str, a: int, b: int) -> None:
    add(
        name,
        f"SELECT tests.* EXCLUDE (id), p.p_value FROM tests LEFT JOIN ({_p_of_t('tests', 'id')}) p USING (id)",
        _WELCH_DOUBLES,
        ctes=f"{ctes}, {_welch(table, metric, a, b)}",
    )


def _mwu(table: str, metric: str, a: int, b: int) -> str:
    """U from mid-ranks over the pooled sample; the normal tail by numerical integration."""
    return f"""
      SELECT n_a, n_b, u, z, CASE WHEN z IS NOT NULL THEN least(1.0::DOUBLE, 1 - 2 * (SELECT
          sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
              * exp(-pow(greatest(z, 0) * i / 2000, 2) / 2)) * greatest(z, 0) / 6000 / sqrt(2 * pi())
          FROM range(2001) r(i))) END AS p_value
      FROM (SELECT *, {div('greatest(u, pairs - u) - pairs / 2 - 0.5', 'sqrt(variance)')} AS z
        FROM (SELECT *, pairs / 12 * (n + 1 - ties / nullif(n * (n - 1), 0)) AS variance
          FROM (SELECT n_a, n_b, rank_a - n_a * (n_a + 1) / 2.0 AS u, CAST(n_a AS DOUBLE) * n_b AS pairs,
                  CAST(n_a + n_b AS DOUBLE) AS n, ties
            FROM (SELECT count(*) FILTER (WHERE exp_group = {a}) AS n_a, count(*) FILTER (WHERE exp_group = {b}) AS n_b,
                    CAST(sum(low + (c - 1) / 2.0) FILTER (WHERE exp_group = {a}) AS DOUBLE) AS rank_a,
                    CAST(sum(c * c - 1) AS DOUBLE) AS ties
              FROM (SELECT exp_group, rank() OVER (ORDER BY {metric}) AS low, count(*) OVER (PARTITION BY {metric}) AS c
                FROM {table} WHERE exp_group IN ({a}, {b}) AND {metric} IS NOT NULL)))))"""


def add_mwu(name: str, ctes: str, table: str, metric: str, a: int, b: int) -> None:
    add(name, _mwu(table, metric, a, b), "u z p_value", ctes=ctes)


_SMOOTH = f"""sm AS (SELECT u.*, (likes + 5.0::DOUBLE * g.ctr_all) / (views + 5.0::DOUBLE) AS smoothed_ctr
  FROM u JOIN (SELECT exp_group, sum(likes)::DOUBLE / sum(views) AS ctr_all FROM u GROUP BY exp_group) g USING (exp_group))"""
_BUCKET = f"""placed AS (SELECT *, {_md5('bucket', 50)} AS bucket FROM u),
bk AS (SELECT exp_group, bucket, count(*) AS users, {div('sum(likes)', 'sum(views)')} AS bucket_ctr,
  list_sort(list(ctr) FILTER (WHERE ctr IS NOT NULL))[least(CAST(floor(0.9::DOUBLE * count(ctr)) AS BIGINT), count(ctr) - 1) + 1] AS ctr9
  FROM placed GROUP BY exp_group, bucket)"""
_AB_SMOOTH, _AB_BUCKET = f"{_AB_USERS}, {_SMOOTH}", f"{_AB_USERS}, {_BUCKET}"

add_welch("welch_ctr", _AB_USERS, "u", "ctr", 2, 1)
add_mwu("mwu_ctr", _AB_USERS, "u", "ctr", 2, 1)
add("smoothed_ctr", "SELECT * FROM sm", "ctr smoothed_ctr", ctes=_AB_SMOOTH)
add_welch("welch_smoothed", _AB_SMOOTH, "sm", "smoothed_ctr", 2, 1)
add_mwu("mwu_smoothed", _AB_SMOOTH, "sm", "smoothed_ctr", 2, 1)
add("bucket_ctr", "SELECT * FROM bk", "bucket_ctr ctr9", ctes=_AB_BUCKET)
add_mwu("mwu_bucket", _AB_BUCKET, "bk", "bucket_ctr", 1, 2)
add_welch("welch_bucket", _AB_BUCKET, "bk", "bucket_ctr", 1, 2)
add_mwu("mwu_bucket_q90", _AB_BUCKET, "bk", "ctr9", 1, 2)
add(
    "overall_ctr",
    f"""SELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
        {div('sum(likes)', 'sum(views)')} AS overall_ctr FROM u WHERE exp_group IN (0, 1) GROUP BY exp_group""",
    "overall_ctr",
    ctes=_AB_ALL,
)
_LINEAR = f"""pairing(exp_group, control) AS (VALUES (0, 0), (3, 0), (1, 1), (2, 1)),
lin AS (SELECT p.control, u.*, c.r AS control_ctr, likes - c.r * views AS linearized_likes
  FROM u JOIN pairing p USING (exp_group)
  JOIN (SELECT exp_group AS control, sum(likes)::DOUBLE / sum(views) AS r FROM u GROUP BY exp_group) c
  ON c.control = p.control)"""
_AB_LINEAR = f"{_AB_ALL}, {_LINEAR}"
add("linearized_likes", "SELECT * FROM lin", "ctr control_ctr linearized_likes", ctes=_AB_LINEAR)
_LINEAR_TESTS = f"""tests AS (SELECT *, {_T} FROM (SELECT control AS control_group,
  max(exp_group) FILTER (WHERE exp_group <> control) AS test_group,
  {_moments('linearized_likes', 'exp_group = control', 'exp_group <> control')} FROM lin GROUP BY control))"""
add(
    "welch_linearized",
    f"SELECT tests.*, p.p_value FROM tests LEFT JOIN ({_p_of_t('tests', 'control_group')}) p USING (control_group)",
    _WELCH_DOUBLES,
    ctes=f"{_AB_LINEAR}, {_LINEAR_TESTS}",
)


def _histogram(table: str, column: str, by: str = "exp_group") -> str:
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}CAST(bin AS INTEGER) AS bin, count(*) AS n,
        low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end
      FROM (SELECT {lead}low, width, least(coalesce(floor((v - low) / nullif(width, 0)), 0), 19) AS bin
        FROM (SELECT {lead}CAST({column} AS DOUBLE) AS v, s.low, (s.high - s.low) / 20.0::DOUBLE AS width
          FROM {table}, (SELECT min({column})::DOUBLE AS low, max({column})::DOUBLE AS high FROM {table}) s
          WHERE {column} IS NOT NULL))
      GROUP BY {lead}bin, low, width"""


def _labelled(variable: str, sql: str) -> str:
    return f"SELECT '{variable}' AS variable, * FROM ({sql})"


add("ctr_histogram", _histogram("u", "ctr"), "bin_start bin_end", ctes=_AB_USERS)
add(
    "linearized_histogram",
    _histogram("pair", "linearized_likes"),
    "bin_start bin_end",
    ctes=f"{_AB_LINEAR}, pair AS (SELECT * FROM lin WHERE exp_group IN (0, 3))",
)


add("smoothed_histogram", _histogram("sm", "smoothed_ctr"), "bin_start bin_end", ctes=_AB_SMOOTH)
add(
    "bucket_histograms",
    " UNION ALL ".join(_labelled(c, _histogram("bk", c)) for c in ["bucket_ctr", "ctr9"]),
    "bin_start bin_end",
    ctes=_AB_BUCKET,
)


def _aa(n: int) -> str:
    """Keyed permutation of the numbers below the next square; the first n images in range are drawn."""
    names = "grp, size, side, iteration, attempt"
    steps = []
    for turn in range(4):
        mixed = hashed(f"turn{turn}", ["grp", "iteration", "r"], str(hash_int(11 + turn)))
        steps.append(
            f"turn{turn + 1} AS (SELECT {names}, r AS l, CAST((l::UBIGINT + h) % side::UBIGINT AS BIGINT) AS r FROM ({mixed}))"
        )
    return f"""
pool AS (SELECT exp_group, row_number() OVER (PARTITION BY exp_group ORDER BY user_id) - 1 AS position, ctr
  FROM u WHERE ctr IS NOT NULL),
sizes AS (SELECT exp_group AS grp, count(*) AS size, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM pool GROUP BY exp_group
  HAVING count(*) >= {n}),
turn0 AS (SELECT grp, size, side, i.iteration, a.attempt, a.attempt // side AS l, a.attempt % side AS r
  FROM sizes, range(10000) i(iteration), range(0, (SELECT coalesce(max(side * side), 0) FROM sizes)) a(attempt)
  WHERE a.attempt < least(side * side, CAST(ceil({n}.0 * side * side / size) AS BIGINT) + {10 * math.isqrt(n) + 20})),
{", ".join(steps)},
picked AS (SELECT grp, iteration, l * side + r AS position FROM turn4 WHERE l * side + r < size
  QUALIFY row_number() OVER (PARTITION BY grp, iteration ORDER BY attempt) <= {n}),
drawn AS (SELECT iteration, {_moments('ctr', 'grp = 2', 'grp = 3')}
  FROM picked JOIN pool ON pool.exp_group = picked.grp AND pool.position = picked.position GROUP BY iteration),
tests AS (SELECT *, {_T} FROM (SELECT * REPLACE (
    coalesce(nullif(n_a, 0), (SELECT count(*) FROM pool WHERE exp_group = 2)) AS n_a,
    coalesce(nullif(n_b, 0), (SELECT count(*) FROM pool WHERE exp_group = 3)) AS n_b)
  FROM range(10000) i(iteration) LEFT JOIN drawn USING (iteration)))"""


_AA_TESTS = f"{_AA_USERS}, {_aa(500)}"
add("aa_stats", "SELECT iteration, n_a, n_b, mean_a, mean_b, t, dof FROM tests", "mean_a mean_b t dof", ctes=_AA_TESTS)
add(
    "aa_stats_spread",
    "SELECT iteration, n_a, n_b, mean_a, mean_b, t, dof FROM tests",
    "mean_a mean_b t dof",
    ctes=f"{_AA_USERS}, {_aa(3)}",
)
_AA_P = f"SELECT tests.iteration, p.p_value FROM tests LEFT JOIN ({_p_of_t('tests', 'iteration')}) p USING (iteration)"
add("aa_pvalues", _AA_P, "p_value", ctes=_AA_TESTS)
add(
    "pvalue_histogram",
    _histogram("pv", "p_value", ""),
    "bin_start bin_end",
    ctes=f"{_AA_TESTS}, pv AS ({_AA_P})",
)
add(
    "aa_fpr",
    f"""SELECT count(p_value) AS tests,
        round(100.0::DOUBLE * count(*) FILTER (WHERE p_value <= 0.05) / nullif(count(p_value), 0), 2) AS false_positive_pct,
        round(100.0::DOUBLE * count(*) FILTER (WHERE p_value <= 0.05) / nullif(count(p_value), 0), 2) <= 5 AS split_is_sound
        FROM ({_AA_P})""",
    "false_positive_pct",
    ctes=_AA_TESTS,
)


def _poisson_case() -> str:
    """Inverse distribution function of Poisson(1) on a 32-bit uniform."""
    cases, total, last, k = [], 0.0, -1, 0
    while True:
        total += math.exp(-1.0) / math.factorial(k)
        bound = math.floor(total * 2**32)
        if bound == last or bound >= 2**32 - 1:
            break
        cases.append(f"WHEN h < {bound} THEN {k}")
        last, k = bound, k + 1
    return f"CASE {' '.join(cases)} ELSE {k} END"


_BOOT = f"""boot_keys AS (SELECT u.exp_group, u.user_id, u.likes, u.views, r.replicate FROM u, range(2000) r(replicate)),
boot_hash AS ({hashed("boot_keys", ["user_id", "replicate"], str(hash_int(23)))}),
boot AS (SELECT exp_group, CAST(replicate AS INTEGER) AS replicate, CAST(sum(w * likes) AS BIGINT) AS likes,
  CAST(sum(w * views) AS BIGINT) AS views, {div('sum(w * likes)', 'sum(w * views)')} AS replicate_ctr
  FROM (SELECT *, {_poisson_case()} AS w FROM boot_hash) GROUP BY exp_group, replicate)"""
_AB_BOOT = f"{_AB_USERS}, {_BOOT}"
add("poisson_bootstrap", "SELECT * FROM boot", "replicate_ctr", ctes=_AB_BOOT)
_BUCKET_BOOT = f"""bucket_sums AS (SELECT exp_group, {_md5('bucket', 50)} AS bucket, sum(likes) AS likes, sum(views) AS views
  FROM u GROUP BY ALL),
boot_keys AS (SELECT s.*, r.replicate FROM bucket_sums s, range(2000) r(replicate)),
boot_hash AS ({hashed("boot_keys", ["exp_group", "bucket", "replicate"], str(hash_int(23)))}),
boot AS (SELECT exp_group, CAST(replicate AS INTEGER) AS replicate, CAST(sum(w * likes) AS BIGINT) AS likes,
  CAST(sum(w * views) AS BIGINT) AS views, {div('sum(w * likes)', 'sum(w * views)')} AS replicate_ctr
  FROM (SELECT *, {_poisson_case()} AS w FROM boot_hash) GROUP BY exp_group, replicate)"""
_AB_BOOT = f"{_AB_USERS}, {_BUCKET_BOOT}"
add("bucket_bootstrap", "SELECT * FROM boot", "replicate_ctr", ctes=_AB_BOOT)
add("bootstrap_histogram", _histogram("boot", "replicate_ctr"), "bin_start bin_end", ctes=_AB_BOOT)
add(
    "bootstrap_diff",
    """SELECT count(d) AS replicates, avg(d) AS mean_diff, min(d) AS min_diff, quantile_cont(d, 0.025) AS low_diff,
       quantile_cont(d, 0.975) AS high_diff, max(d) AS max_diff, min(d) > 0 OR max(d) < 0 AS excludes_zero
       FROM (SELECT a.replicate_ctr - b.replicate_ctr AS d FROM boot a JOIN boot b USING (replicate)
             WHERE a.exp_group = 2 AND b.exp_group = 1)""",
    "mean_diff min_diff low_diff high_diff max_diff",
    ctes=_AB_BOOT,
)


def _experiment_report() -> str:
    parts, ctes = [], [_AB_USERS, _SMOOTH, _BUCKET]
    for i, (metric, table, column) in enumerate(
        [("ctr", "u", "ctr"), ("smoothed_ctr", "sm", "smoothed_ctr"), ("bucket_ctr", "bk", "bucket_ctr")]
    ):
        ctes.append(_welch(table, column, 2, 1).replace("tests AS", f"tests{i} AS"))
        parts.append(
            f"SELECT '{metric}' AS metric, 'welch' AS method, t AS statistic, p_value "
            f"FROM tests{i} LEFT JOIN ({_p_of_t(f'tests{i}', 'id')}) USING (id)"
        )
        parts.append(f"SELECT '{metric}', 'mann_whitney', u, p_value FROM ({_mwu(table, column, 2, 1)})")
    parts.append(f"SELECT 'bucket_q90', 'mann_whitney', u, p_value FROM ({_mwu('bk', 'ctr9', 2, 1)})")
    ctes.append(
        """lin AS (SELECT u.*, likes - c.r * views AS linearized_likes FROM u,
           (SELECT sum(likes)::DOUBLE / sum(views) AS r FROM u WHERE exp_group = 1) c)"""
    )
    ctes.append(_welch("lin", "linearized_likes", 1, 2).replace("tests AS", "tests3 AS"))
    parts.append(
        f"SELECT 'linearized_likes', 'welch', t, p_value FROM tests3 "
        f"LEFT JOIN ({_p_of_t('tests3', 'id')}) USING (id)"
    )
    add("experiment_report", " UNION ALL ".join(parts), "statistic p_value", ctes=", ".join(ctes))


_experiment_report()

# --- anomalies -------------------------------------------------------------

_METRICS = ["users_feed", "views", "likes", "ctr", "users_messenger", "messages"]
_SLOT_COLUMNS = f"""count(DISTINCT user_id) FILTER (WHERE action = 'view') AS users_feed,
  {VIEWS} AS views, {LIKES} AS likes, {div(LIKES, VIEWS)} AS ctr,
  count(DISTINCT user_id) FILTER (WHERE action = 'message') AS users_messenger, {MESSAGES} AS messages"""
_RECENT = "time >= TIMESTAMP '2024-01-29 00:00:00' AND time < TIMESTAMP '2024-01-30 23:45:00'"


def _slots(where: str) -> str:
    return f"""slots AS (SELECT {SLOT} AS ts, CAST({SLOT} AS DATE) AS date, strftime({SLOT}, '%H:%M') AS hm,
        {_SLOT_COLUMNS} FROM act WHERE {where} GROUP BY 1, 2, 3)"""


_SERIES = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, ts, CAST({m} AS DOUBLE) AS value FROM slots" for m in _METRICS
)


def _bands(ahead: int) -> str:
    # one branch per metric, and rows of the frame picked by row number
    return f"""series AS ({_SERIES}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts) AS i FROM series),
quarters AS (SELECT c.metric, c.ts, c.value, c.i,
    CASE WHEN count(p.value) = 5 THEN quantile_cont(p.value, 0.25) END AS q25,
    CASE WHEN count(p.value) = 5 THEN quantile_cont(p.value, 0.75) END AS q75,
    max(CASE WHEN p.i = c.i - 1 THEN p.value END) AS previous_value
  FROM numbered c LEFT JOIN numbered p ON p.metric = c.metric AND p.i BETWEEN c.i - 5 AND c.i - 1
  GROUP BY c.metric, c.ts, c.value, c.i),
bands AS (SELECT c.metric, c.ts, c.value, c.q25, c.q75, c.i, c.previous_value,
    avg(w.q75 + 3 * (w.q75 - w.q25)) AS up, avg(w.q25 - 3 * (w.q75 - w.q25)) AS low
  FROM quarters c JOIN quarters w ON w.metric = c.metric AND w.i BETWEEN c.i - 2 AND c.i + {ahead}
  GROUP BY ALL)"""


_OUT = "coalesce(value < low OR value > up, FALSE)"
_BANDS = f"{_slots(_RECENT)}, {_bands(2)}"
_HISTORY = f"{_slots('TRUE')}, {_bands(0)}"
add("quarter_hour", "SELECT * FROM slots", "ctr", "ts date", ctes=_slots(_RECENT))
add(
    "quarter_hour_filled",
    f"""SELECT g.ts, CAST(g.ts AS DATE) AS date, strftime(g.ts, '%H:%M') AS hm,
        {', '.join('ctr' if m == 'ctr' else f'coalesce({m}, 0) AS {m}' for m in _METRICS)}
        FROM generate_series(TIMESTAMP '2024-01-29 00:00:00', TIMESTAMP '2024-01-30 23:30:00', INTERVAL 15 MINUTE) g(ts)
        LEFT JOIN slots ON slots.ts = g.ts""",
    "ctr",
    "ts date",
    ctes=_slots(_RECENT),
)
add("iqr_bands", "SELECT * EXCLUDE (i) FROM bands", "value q25 q75 up low previous_value", "ts", ctes=_BANDS)
_LATEST = f"""SELECT metric, ts, value, previous_value, low, up, {_OUT} AS is_alert FROM bands
  WHERE ts = (SELECT max(ts) FROM slots)"""
add("latest_alerts", _LATEST, "value previous_value low up", "ts", ctes=_BANDS)
add(
    "alert_messages",
    f"""SELECT metric, ts, 'Metric ' || metric || ':' || chr(10) || 'current value ' || format('{{:.2f}}', value)
        || chr(10) || 'change from previous value '
        || CASE WHEN previous_value IS NULL OR previous_value = 0 THEN 'n/a'
           ELSE format('{{:.2f}}', abs(1 - value / previous_value) * 100) || '%' END AS text
        FROM ({_LATEST}) WHERE is_alert""",
    texts="ts",
    ctes=_BANDS,
)
add(
    "day_over_day",
    f"""SELECT ts, metric, value, day_before, {div('value', 'day_before')} - 1 AS change,
        coalesce(abs({div('value', 'day_before')} - 1) > 0.3, FALSE) AS is_alert
        FROM (SELECT *, max(value) OVER day_before AS day_before, count(*) OVER day_before AS known FROM series
          WINDOW day_before AS (PARTITION BY metric ORDER BY ts
            RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
        WHERE known > 0""",
    "value day_before change",
    "ts",
    ctes=f"{_slots(_RECENT).replace('slots AS (', 'slots AS MATERIALIZED (')}, series AS ({_SERIES})",
)
add("band_breaks", f"SELECT metric, ts, value, low, up FROM bands WHERE {_OUT}", "value low up", "ts", ctes=_HISTORY)
# A live slot is closed once the newest event is an hour past its end.
_CLOSED = f"{SLOT} + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
add("stream_quarter_hour", "SELECT * EXCLUDE (date, hm) FROM slots", "ctr", "ts", ctes=_slots(_CLOSED))
add(
    "stream_alerts",
    f"SELECT metric, ts, value, previous_value, low, up FROM bands WHERE {_OUT}",
    "value previous_value low up",
    "ts",
    ctes=f"{_slots(_CLOSED)}, {_bands(0)}",
)

# --- posts and series ------------------------------------------------------

_POSTS = f"""pa AS (SELECT post_id, nullif({LIKES}, 0) AS "like", nullif({VIEWS}, 0) AS "view" FROM feed GROUP BY post_id)"""
add("post_actions", "SELECT * FROM pa", ctes=_POSTS)
add(
    "post_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, count(*) AS count, round(avg(v), 2) AS mean, round(stddev_samp(v), 2) AS std,
            min(v) AS min, round(quantile_cont(v, 0.25), 2) AS q25, round(quantile_cont(v, 0.5), 2) AS median,
            round(quantile_cont(v, 0.75), 2) AS q75, max(v) AS max
            FROM (SELECT CAST(coalesce("{c}", 0) AS DOUBLE) AS v FROM pa)"""
        for c in ["like", "view"]
    ),
    "mean std min q25 median q75 max",
    ctes=_POSTS,
)


def _shape(name: str, value: str) -> str:
    return f"""SELECT '{name}' AS variable, skewness, mean, mode, median,
        CASE WHEN skewness > 0 THEN 'right' WHEN skewness < 0 THEN 'left' ELSE 'none' END AS longer_tail
      FROM (SELECT avg(pow(v - m, 3)) / pow(avg(pow(v - m, 2)), 1.5) AS skewness, any_value(m) AS mean,
              quantile_cont(v, 0.5) AS median
            FROM (SELECT CAST({value} AS DOUBLE) AS v FROM pa WHERE {value} IS NOT NULL),
                 (SELECT avg(CAST({value} AS DOUBLE)) AS m FROM pa)),
           (SELECT CAST({value} AS DOUBLE) AS mode FROM pa WHERE {value} IS NOT NULL
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""


add(
    "post_skew",
    " UNION ALL ".join(
        [_shape("like", '"like"'), _shape("view", '"view"'), _shape("ctr", div('"like"', '"view"'))]
    ),
    "skewness mean mode median",
    ctes=_POSTS,
)
add(
    "post_histograms",
    " UNION ALL ".join(
        _labelled(name, _histogram("pc", column, ""))
        for name, column in [("like", '"like"'), ("view", '"view"'), ("ctr", "ctr")]
    ),
    "bin_start bin_end",
    ctes=f"""{_POSTS}, pc AS (SELECT *, {div('"like"', '"view"')} AS ctr FROM pa)""",
)
_Z = """z AS (SELECT post_id, ("like" - (SELECT avg("like") FROM pa)) / (SELECT stddev_samp("like") FROM pa) AS "like",
  ("view" - (SELECT avg("view") FROM pa)) / (SELECT stddev_samp("view") FROM pa) AS "view" FROM pa)"""
add(
    "post_zscore",
    "SELECT post_id, \"like\" AS \"like\", \"view\" AS \"view\" FROM z",
    '"like" "view"',
    ctes=f"{_POSTS}, {_Z}",
)
_PROBS = [i / 20 for i in range(1, 20)]
add(
    "qq_like_view",
    " UNION ALL ".join(
        f"""SELECT {p}::DOUBLE AS prob, (SELECT quantile_cont("like", {p}) FROM z) AS quantile_like,
            (SELECT quantile_cont("view", {p}) FROM z) AS quantile_view"""
        for p in _PROBS
    ),
    "prob quantile_like quantile_view",
    ctes=f"{_POSTS}, {_Z}",
)
_STATS = f"""ps AS (SELECT post_id, {LIKES} AS likes, {VIEWS} AS views, min(time) AS min_time, max(time) AS max_time,
  {div(LIKES, VIEWS)} AS ctr, CAST(date_diff('day', min(time), max(time)) AS INTEGER) AS life_time FROM feed GROUP BY post_id)"""
add("post_stats", "SELECT * FROM ps", "ctr", "min_time max_time", ctes=_STATS)
add("mean_lifetime", "SELECT avg(life_time) AS avg_life_time_days FROM ps", "avg_life_time_days", ctes=_STATS)
_CORR = ["likes", "views", "ctr", "life_time"]
add(
    "post_corr",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM ps"
        for a in _CORR
        for b in _CORR
    ),
    "r",
    ctes=_STATS,
)
_HOURS = "hours AS (SELECT date_trunc('hour', time) AS day_h, count(user_id) AS actions FROM feed GROUP BY 1)"
add("hourly_actions", "SELECT * FROM hours", texts="day_h", ctes=_HOURS)
_CLASSICAL = f"""{_HOURS},
filled AS (SELECT g.day_h, CAST(coalesce(actions, 0) AS DOUBLE) AS y,
    row_number() OVER (ORDER BY g.day_h) AS i
  FROM generate_series((SELECT min(day_h) FROM hours), (SELECT max(day_h) FROM hours), INTERVAL 1 HOUR) g(day_h)
  LEFT JOIN hours ON hours.day_h = g.day_h),
trended AS (SELECT c.day_h, c.i, c.y, CASE WHEN count(*) = 25
    THEN sum(w.y * CASE WHEN abs(w.i - c.i) = 12 THEN 0.5 ELSE 1 END) / 24 END AS trend
  FROM filled c JOIN filled w ON w.i BETWEEN c.i - 12 AND c.i + 12 GROUP BY ALL),
raw_season AS (SELECT hour(day_h) AS h, avg(y - trend) AS s FROM trended GROUP BY 1)"""
add(
    "classical_hourly",
    """SELECT 'all' AS series, day_h, y AS observed, trend, s - (SELECT avg(s) FROM raw_season) AS seasonal,
       y - trend - (s - (SELECT avg(s) FROM raw_season)) AS resid
       FROM trended JOIN raw_season ON h = hour(day_h)""",
    "observed trend seasonal resid",
    "day_h",
    ctes=_CLASSICAL,
)
_BY_HOUR = "SELECT CAST(hour(time) AS INTEGER) AS hour, count(user_id) AS actions FROM feed GROUP BY 1"
_PUBLISHED = """SELECT CAST(hour(t) AS INTEGER) AS hour, count(DISTINCT post_id) AS posts
  FROM (SELECT post_id, min(date_trunc('hour', time)) AS t FROM feed GROUP BY post_id) GROUP BY 1"""
add("actions_by_hour", _BY_HOUR)
add("posts_by_hour", _PUBLISHED)
add(
    "hour_profiles",
    f"""SELECT hour, actions, posts, {div('actions', '(SELECT sum(actions) FROM p)')} AS actions_share,
        actions = (SELECT max(actions) FROM p) AS actions_peak,
        {div('posts', '(SELECT sum(posts) FROM p)')} AS posts_share,
        posts = (SELECT max(posts) FROM p) AS posts_peak FROM p""",
    "actions_share posts_share",
    ctes=f"""p AS (SELECT coalesce(a.hour, b.hour) AS hour, coalesce(actions, 0) AS actions, coalesce(posts, 0) AS posts
      FROM ({_BY_HOUR}) a FULL JOIN ({_PUBLISHED}) b ON a.hour = b.hour)""",
)
