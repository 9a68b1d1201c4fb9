"""Driver-table queries for the sequence operators (WN1-WN4, WN11, WN13, WN16).

Mapping (SURVEY 7.4): patient = events.user_id, time = events.ts, location/value text = events.event_type,
numeric value = events.value, tie-break = events.event_id.
"""

from __future__ import annotations

from homesense.operators import sequences as seq
from homesense.plans.registry import register, round_doubles, table

_W = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


@register("transitions", f"""
SELECT user_id, start_date, end_date, source, sink, source || '>' || sink AS transition, round(dur, 6) AS dur
FROM (SELECT user_id, ts AS start_date, lead(ts) OVER w AS end_date,
             coalesce(event_type, 'nan') AS source, lead(coalesce(event_type, 'nan')) OVER w AS sink,
             (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS dur
      FROM events WHERE user_id IS NOT NULL {_W})
WHERE end_date IS NOT NULL
""", "WN1", "D8")
def q_transitions(spark, sf):
    ev = table(spark, sf, "events")
    return round_doubles(seq.transitions(ev, ["user_id"], "ts", "event_type", tiebreak="event_id"))


@register("transitions_cov", f"""
SELECT user_id, start_date, end_date, source, sink, value, source || '>' || sink AS transition,
       round(dur, 6) AS dur
FROM (SELECT user_id, ts AS start_date, lead(ts) OVER w AS end_date, round(value, 6) AS value,
             coalesce(event_type, 'nan') AS source, lead(coalesce(event_type, 'nan')) OVER w AS sink,
             (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS dur
      FROM events WHERE user_id IS NOT NULL {_W})
WHERE end_date IS NOT NULL AND value IS NOT NULL
""", "WN1")
def q_transitions_cov(spark, sf):
    ev = table(spark, sf, "events")
    return round_doubles(seq.transitions(ev, ["user_id"], "ts", "event_type", covariates=["value"],
                                         tiebreak="event_id"))


def _mine_sql(k: int) -> str:
    path = " || '>' || ".join(["event_type"] + [f"lead(event_type, {j}) OVER w" for j in range(1, k + 1)])
    return f"""
SELECT user_id, start_date, end_date, source, sink, transition, round(dur, 6) AS dur
FROM (SELECT user_id, ts AS start_date, lead(ts, {k}) OVER w AS end_date, event_type AS source,
             lead(event_type, {k}) OVER w AS sink, {path} AS transition,
             (epoch_us(lead(ts, {k}) OVER w) - epoch_us(ts)) / 1e6 AS dur
      FROM (SELECT DISTINCT user_id, ts, event_type, event_id FROM events WHERE user_id IS NOT NULL)
      {_W})
WHERE end_date IS NOT NULL
"""


def _mine(k):
    def q(spark, sf):
        ev = table(spark, sf, "events").select("user_id", "ts", "event_type", "event_id")
        return round_doubles(seq.mine_transition(ev, ["user_id"], "event_type", "ts", window=k, tiebreak="event_id"))
    return q


register("mine_transition_1", _mine_sql(1), "WN2")(_mine(1))
register("mine_transition_2", _mine_sql(2), "WN2")(_mine(2))


@register("ngrams", f"""
SELECT user_id, start_date, ngram FROM (
  SELECT user_id, ts AS start_date,
         event_type || '>' || lead(event_type, 1) OVER w || '>' || lead(event_type, 2) OVER w AS ngram,
         lead(1, 2) OVER w AS last_
  FROM events WHERE user_id IS NOT NULL {_W})
WHERE last_ IS NOT NULL
""", "WN3")
def q_ngrams(spark, sf):
    return seq.ngrams(table(spark, sf, "events"), ["user_id"], "ts", "event_type", 3, tiebreak="event_id")


@register("lag_matrix", f"""
SELECT user_id, ts, "t(-2)", "t(-1)", "t(-0)" FROM (
  SELECT user_id, ts, round(value, 6) AS "t(-2)", round(lag(value, 1) OVER w, 6) AS "t(-1)",
         round(lag(value, 2) OVER w, 6) AS "t(-0)"
  FROM events WHERE user_id IS NOT NULL {_W})
WHERE "t(-2)" IS NOT NULL AND "t(-1)" IS NOT NULL AND "t(-0)" IS NOT NULL
""", "WN4")
def q_lag_matrix(spark, sf):
    return round_doubles(seq.lag_matrix(table(spark, sf, "events"), ["user_id"], "ts", "value", 3,
                                        tiebreak="event_id"))


@register("count_gaps", f"""
SELECT user_id, CAST(sum(CASE WHEN (epoch_us(ts) - epoch_us(p)) / 1e6 > 21600 THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps
FROM (SELECT user_id, ts, lag(ts) OVER w AS p FROM events WHERE user_id IS NOT NULL {_W})
GROUP BY user_id
""", "WN11")
def q_count_gaps(spark, sf):
    return seq.count_gaps(table(spark, sf, "events"), ["user_id"], "ts", 21600, tiebreak="event_id")


@register("door_episodes", f"""
SELECT user_id, start_date, end_date, round(dur, 6) AS dur FROM (
  SELECT user_id, lag(ts) OVER w AS start_date, ts AS end_date, event_type,
         lag(event_type) OVER w AS prev, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dur
  FROM events WHERE user_id IS NOT NULL {_W})
WHERE event_type = 'click' AND prev = 'view' AND dur < 21600
""", "WN13")
def q_door_episodes(spark, sf):
    return round_doubles(seq.door_episodes(table(spark, sf, "events"), ["user_id"], "ts", "event_type",
                                           open_word="view", close_word="click", max_seconds=21600,
                                           tiebreak="event_id"))


@register("pathways", f"""
WITH ends AS (SELECT DISTINCT user_id, ts, event_type, event_id FROM events
              WHERE event_type IN ('view', 'purchase') AND user_id IS NOT NULL),
t AS (SELECT user_id, ts AS start_date, lead(ts) OVER w AS end_date, event_type AS source,
             lead(event_type) OVER w AS sink FROM ends {_W}),
ep AS (SELECT *, source || '>' || sink AS transition, (epoch_us(end_date) - epoch_us(start_date)) / 1e6 AS dur
       FROM t WHERE end_date IS NOT NULL)
SELECT ep.user_id, start_date, end_date, source, sink, transition, round(dur, 6) AS dur,
       string_agg(e.event_type, '>' ORDER BY e.ts, e.event_id) AS pathway
FROM ep JOIN events e ON e.user_id = ep.user_id AND e.ts >= ep.start_date AND e.ts <= ep.end_date
WHERE transition = 'view>purchase' AND dur > 600 AND dur < 43200
GROUP BY ep.user_id, start_date, end_date, source, sink, transition, dur
""", "WN16", "JN7")
def q_pathways(spark, sf):
    ev = table(spark, sf, "events")
    return round_doubles(seq.pathways(ev, ["user_id"], "ts", "event_type", "view", "purchase",
                                      min_dur=600, max_dur=43200, tiebreak="event_id"))
