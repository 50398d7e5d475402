"""SQL twins of ``fixtures.py``: common table expressions the oracles start with."""

#: topic ``events``
L = """l AS (SELECT *, CAST(user_id % 4 AS INT) AS part_id, CAST(user_id % 4 % 2 AS INT) AS member_id,
 ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS log_offset FROM events)"""

#: topics ``ev-<type>``
M = """m AS (SELECT *, 'ev-' || event_type AS topic, CAST(user_id % 4 AS INT) AS part_id,
 ROW_NUMBER() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS log_offset FROM events)"""

#: acknowledgements (needs L)
A = """a AS (SELECT *, event_id // 10007 * 10007 + (event_id * 7919) % 10007 AS ack_seq FROM l WHERE value <= 250)"""

#: committed offsets of group g (needs L)
C = """cm AS (SELECT part_id, COUNT(*) // 2 AS commit_offset FROM l WHERE part_id < 3 GROUP BY part_id)"""

#: transactions of topic ``events``
T = """tx AS (SELECT event_id // 500 AS no, MAX(value) AS slowest FROM events WHERE event_type <> 'signup' GROUP BY 1),
ts_state AS (SELECT no, CASE WHEN no = (SELECT MAX(no) FROM tx) THEN 'open' WHEN slowest > 350 THEN 'aborted' ELSE 'committed' END AS state FROM tx)"""

#: send requests
R = """r AS (SELECT event_type AS sender_id, event_id AS seq, user_id, ts, value, props,
 CAST(CASE WHEN event_id % 2 = 1 THEN event_id % 4 ELSE user_id % 4 END AS INT) AS part_id,
 CASE WHEN value < 0.1 THEN 'InvalidTopicException' WHEN value > 380 THEN 'AuthenticationException' END AS error FROM events)"""

#: completed sends
S = """s AS (SELECT CAST(user_id % 4 AS INT) AS sender_id, event_id AS seq, event_type,
 epoch_us(ts) // 1000 - CAST(ROUND(value) AS INT) AS start_ms, epoch_us(ts) // 1000 AS end_ms,
 CAST(ROUND(value) AS BIGINT) AS latency, strlen(props) AS bytes FROM events)"""


def rank_at(p: str, cum: str = "cum", total: str = "total", value: str = "latency") -> str:
    """Nearest rank over a histogram with a running count."""
    return f"MIN(CASE WHEN {cum} > FLOOR(CAST({p} AS DOUBLE) * {total}) THEN {value} END)"
