"""The feed and message logs as common table expressions over the provided views."""

from __future__ import annotations

from oracle.hashing import hash_int, hashed

# The hash seed of each derived column.
SEEDS = {
    "start": 1, "gap": 2, "age": 3, "os": 4, "gender": 5,
    "source": 6, "exp_group": 7, "nation": 8, "city": 9, "moves": 10,
}


def _keys(entries: list[tuple[str, str]], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT DISTINCT '{kind}' AS kind, {x} AS x, {hash_int(SEEDS[kind])} AS seed FROM {table}"
        for kind, x in entries
    )


_PROFILE = ["age", "os", "gender", "source", "exp_group", "nation", "city", "moves"]

_COLUMNS = "age, os, gender, country, city, source, exp_group"
# every fifth user comes from the other source from the fifteenth day on
_DERIVED = _COLUMNS.replace(
    "source", "CASE WHEN a.d >= 15 AND moves % 5 = 0 THEN CASE source WHEN 'ads' THEN 'organic' ELSE 'ads' END ELSE source END AS source"
)

LOGS = f"""
raw AS (
  SELECT user_id AS raw_id, ts AS time, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CAST(ts AS DATE) - DATE '2024-01-01' AS d
  FROM events),
day_keys AS ({_keys([("start", "raw_id"), ("gap", "raw_id * 4096 + d // 7")], "raw")}),
day_hash AS ({hashed("day_keys", ["x"], "seed")}),
account AS (
  SELECT raw.time, raw.event_type, raw.k, raw.d, raw_id // 150 AS block,
         raw_id * 2 + CASE WHEN raw.d >= s.h % 20 AND g.h % 3 <> 0 THEN 1 ELSE 0 END AS user_id
  FROM raw
  JOIN day_hash s ON s.kind = 'start' AND s.x = raw_id
  JOIN day_hash g ON g.kind = 'gap' AND g.x = raw_id * 4096 + raw.d // 7),
user_keys AS ({_keys([(kind, "user_id") for kind in _PROFILE], "account")}),
user_hash AS ({hashed("user_keys", ["x"], "seed")}),
user_draw AS (
  SELECT x AS user_id, {", ".join(f"max(CASE WHEN kind = '{k}' THEN h END) AS {k}" for k in _PROFILE)}
  FROM user_hash GROUP BY x),
profile AS (
  SELECT user_id, CAST(14 + age % 47 AS INTEGER) AS age,
         CASE WHEN os % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
         CAST(gender % 2 AS INTEGER) AS gender,
         n_name AS country, n_name || '-' || CAST(city % 3 AS VARCHAR) AS city,
         CASE WHEN source % 2 = 0 THEN 'ads' ELSE 'organic' END AS source, moves,
         CAST(exp_group % 4 AS INTEGER) AS exp_group
  FROM user_draw LEFT JOIN nation ON n_nationkey = CAST(nation % 25 AS BIGINT)),
feed AS (
  SELECT a.user_id, a.block * 1000 + a.k * 10 + a.d // 3 AS post_id, a.time, CAST(a.time AS DATE) AS date,
         CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action, {_DERIVED}
  FROM account a JOIN profile USING (user_id) WHERE event_type <> 'purchase'),
msg AS (
  SELECT a.user_id, a.block * 300 + a.k AS receiver_id, a.time, CAST(a.time AS DATE) AS date, {_DERIVED}
  FROM account a JOIN profile USING (user_id) WHERE event_type = 'purchase'),
act AS (
  SELECT user_id, time, date, {_COLUMNS}, action FROM feed
  UNION ALL SELECT user_id, time, date, {_COLUMNS}, 'message' FROM msg)
"""
