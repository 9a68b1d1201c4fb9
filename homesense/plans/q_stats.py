"""Driver-table queries for statistics and profile recipes (AG6, AG9, AG16-AG20, WN8-WN10, WN14, FIL15,
SC18, D13, D14, D25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homesense.functions.scalars import map_strict, round_quarter, safe_ratio
from homesense.functions.time import minute_bin, time_angle
from homesense.operators import resample as rs
from homesense.operators import stats as st
from homesense.plans import q_resample, q_segments
from homesense.plans.recipes import profile as pf
from homesense.plans.registry import register, round_doubles, table

TOD = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"


@register("circular_mean", f"""
SELECT user_id, round(x - 360.0 * floor(x / 360.0), 6) AS mean_angle FROM (
  SELECT user_id, degrees(atan2(sum(sin(radians({TOD} / 240.0))), sum(cos(radians({TOD} / 240.0))))) AS x
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
""", "AG16")
def q_circular_mean(spark, sf):
    ev = table(spark, sf, "events").where(F.col("user_id").isNotNull())
    return round_doubles(ev.groupBy("user_id").agg(st.circular_mean(time_angle("ts")).alias("mean_angle")))


@register("circular_std", f"""
SELECT user_id, round(CASE WHEN r > 0 THEN degrees(sqrt(-2 * ln(r))) END, 6) AS std_angle FROM (
  SELECT user_id, least(1.0, sqrt(avg(sin(radians({TOD} / 240.0))) ** 2 + avg(cos(radians({TOD} / 240.0))) ** 2)) AS r
  FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
""", "AG17")
def q_circular_std(spark, sf):
    ev = table(spark, sf, "events").where(F.col("user_id").isNotNull())
    return round_doubles(ev.groupBy("user_id").agg(st.circular_std(time_angle("ts")).alias("std_angle")))


@register("rolling_zscore", """
WITH d AS (SELECT user_id, time_bucket(INTERVAL 1 day, ts, INTERVAL 12 hours) AS start_date,
                  avg(CASE WHEN event_type <> 'error' THEN value END) AS x
           FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
z AS (SELECT *, avg(x) OVER w AS m, stddev_samp(x) OVER w AS s FROM d
      WINDOW w AS (PARTITION BY user_id, x IS NULL ORDER BY start_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT user_id, start_date, round(x, 6) AS x,
       round(CASE WHEN x IS NULL OR s IS NULL OR s = 0 THEN NULL ELSE (x - m) / s END, 6) AS x_z
FROM z
""", "WN8")
def q_rolling_zscore(spark, sf):
    ev = table(spark, sf, "events")
    d = rs.resample(ev, ["user_id"], "ts", 86_400,
                    {"x": F.avg(F.when(F.col("event_type") != "error", F.col("value")))}, 12 * 3600, dense=False)
    return round_doubles(st.rolling_zscore(d, ["user_id"], "start_date", "x", 14))


@register("time_cdf", """
WITH t AS (SELECT event_type, CASE WHEN value > 50 THEN time_bucket(INTERVAL 1 minute, ts) ELSE ts END AS t
           FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL),
c AS (SELECT event_type, CASE WHEN epoch_us(t) % 60000000 = 0 THEN hour(t) * 60 + minute(t) END AS m, count(*) AS n
      FROM t GROUP BY ALL),
s AS (SELECT event_type, m, n / sum(n) OVER (PARTITION BY event_type) AS share FROM c),
g AS (SELECT event_type, unnest(range(0, 1441)) AS step FROM (SELECT DISTINCT event_type FROM c))
SELECT g.event_type, g.step, printf('%02d:%02d:00', ((step + 720) % 1440) // 60, (step + 720) % 60) AS time,
       round(sum(coalesce(s.share, 0.0)) OVER (PARTITION BY g.event_type ORDER BY g.step ROWS UNBOUNDED PRECEDING), 6)
         AS cdf
FROM g LEFT JOIN s ON s.event_type = g.event_type AND s.m = (g.step + 720) % 1440
""", "WN9", "AG15")
def q_time_cdf(spark, sf):
    ev = table(spark, sf, "events")
    t = F.when(F.col("value") > 50, minute_bin("ts")).otherwise(F.col("ts"))
    out = st.time_cdf(ev.select("event_type", t.alias("t")), ["event_type"], "t")
    return round_doubles(out.withColumn("step", F.col("step").cast("long")))


def _quarter_angles(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_type", round_quarter(time_angle("ts")).alias("v"))


_HIST_SQL = f"""
v AS (SELECT event_type, round_even({TOD} / 240.0 * 4, 0) / 4 AS v FROM events WHERE event_type IS NOT NULL),
hits AS (SELECT event_type, CAST(v / 0.25 AS INTEGER) AS i, count(*) AS freq FROM v
         WHERE v >= 0 AND v / 0.25 < 1440 AND v / 0.25 = floor(v / 0.25) GROUP BY ALL),
g AS (SELECT event_type, unnest(range(0, 1440)) AS i FROM (SELECT DISTINCT event_type FROM v)),
h AS (SELECT g.event_type, g.i, g.i * 0.25 AS bin, coalesce(hits.freq, 0) AS freq
      FROM g LEFT JOIN hits USING (event_type, i)),
head AS (SELECT event_type, regr_slope(freq, i) AS hs, regr_intercept(freq, i) AS hi FROM h WHERE i < 59 GROUP BY 1),
tail AS (SELECT event_type, regr_slope(freq, i) AS tsl, regr_intercept(freq, i) AS ti FROM h
         WHERE i >= 1440 - 59 GROUP BY 1),
s AS (SELECT h.*, CASE WHEN i < 29 THEN hi + hs * i WHEN i >= 1440 - 29 THEN ti + tsl * i
                       ELSE avg(freq) OVER (PARTITION BY h.event_type ORDER BY i
                                            ROWS BETWEEN 29 PRECEDING AND 29 FOLLOWING) END AS freq_smooth
      FROM h JOIN head USING (event_type) JOIN tail USING (event_type))"""


@register("smooth_hist", f"""
WITH {_HIST_SQL}
SELECT event_type, i, bin, freq, round(freq_smooth, 6) AS freq_smooth,
       round(sum(freq_smooth) OVER (PARTITION BY event_type ORDER BY i ROWS UNBOUNDED PRECEDING), 6) AS freq_cumsum
FROM s
""", "WN10")
def q_smooth_hist(spark, sf):
    h = st.histogram_grid(_quarter_angles(spark, sf), ["event_type"], "v")
    return round_doubles(st.smooth_histogram(h, ["event_type"]).withColumn("i", F.col("i").cast("long")))


_LABEL_SQL = f"""
WITH RECURSIVE {_HIST_SQL.strip()},
f AS (SELECT event_type, i, bin, freq, freq_smooth, sum(freq_smooth) OVER (
        PARTITION BY event_type ORDER BY i ROWS UNBOUNDED PRECEDING) AS freq_cumsum,
      row_number() OVER (PARTITION BY event_type ORDER BY round(freq_smooth, 6) DESC, i) AS rk FROM s),
o AS (SELECT event_type, list(i ORDER BY rk) AS bins FROM f GROUP BY event_type),
walk AS (
  SELECT event_type, bins, 0 AS k, list_transform(range(0, 1440), lambda x: 0) AS lab, 0 AS top FROM o
  UNION ALL
  SELECT event_type, bins, k + 1, list_concat(lab[1:pos], [lbl], lab[pos + 2:1440]), greatest(top, lbl) FROM (
    SELECT *, CASE WHEN len(near) = 0 THEN top + 1 ELSE uniq[list_position(votes, list_max(votes))] END AS lbl FROM (
      SELECT *, list_transform(uniq, lambda u: len(list_filter(near, lambda x: x = u))) AS votes FROM (
        SELECT *, list_sort(list_distinct(near)) AS uniq FROM (
          SELECT *, list_filter(list_transform(range(-10, 10), lambda d: lab[greatest(0, least(1439, pos + d)) + 1]),
                                lambda x: x > 0) AS near FROM (
            SELECT *, bins[k + 1] AS pos FROM walk WHERE k < 1440)))))),
labelled AS (SELECT f.event_type, f.i, f.bin, f.freq, f.freq_smooth, f.freq_cumsum, w.lab[f.i + 1] AS labels
             FROM f JOIN walk w ON w.event_type = f.event_type AND w.k = 1440)"""


@register("segment_freq", f"""{_LABEL_SQL}
SELECT event_type, i, bin, freq, round(freq_smooth, 6) AS freq_smooth, round(freq_cumsum, 6) AS freq_cumsum, labels
FROM labelled
""", "WN14", "UD6")
def q_segment_freq(spark, sf):
    return round_doubles(st.segment_freq(_quarter_angles(spark, sf), ["event_type"], "v").withColumn("i", F.col("i").cast("long")))


@register("segment_summary", f"""{_LABEL_SQL},
t AS (SELECT event_type, labels, min(bin) AS lo, max(bin) AS hi, CAST(sum(freq) AS BIGINT) AS freq_sum
      FROM labelled GROUP BY event_type, labels),
c AS (SELECT *, (lo + 180) % 360 AS a, (hi + 180) % 360 AS z FROM t)
SELECT event_type, labels, printf('%02d:%02d:00', CAST(a * 4 AS INTEGER) // 60, CAST(a * 4 AS INTEGER) % 60) AS "start",
       printf('%02d:%02d:00', CAST(z * 4 AS INTEGER) // 60, CAST(z * 4 AS INTEGER) % 60) AS "end",
       freq_sum, round(freq_sum / sum(freq_sum) OVER (PARTITION BY event_type), 6) AS proportion
FROM c
""", "AG20")
def q_segment_summary(spark, sf):
    seg = st.segment_freq(_quarter_angles(spark, sf), ["event_type"], "v")
    return round_doubles(st.segment_summary(seg, ["event_type"]))


_ACT = ["click", "purchase", "signup", "view"]


@register("row_share", f"""
WITH a AS ({q_resample.ACTIVITY_DAILIES_SQL})
SELECT user_id, start_date, Total, {", ".join(f"round({c} / Total, 6) AS {c}_share" for c in _ACT)} FROM a
""", "FIL15")
def q_row_share(spark, sf):
    a = q_resample.activity_dailies(spark, sf)
    return round_doubles(a.select("user_id", "start_date", "Total",
                                  *[safe_ratio(F.col(c), F.col("Total")).alias(f"{c}_share") for c in _ACT]))


# ---------------------------------------------------------------- sleep model



def _ratio_sql(num: str, den: str) -> str:
    return (f"CASE WHEN ({den}) = 0 THEN CASE WHEN ({num}) > 0 THEN 'inf'::DOUBLE WHEN ({num}) < 0 THEN '-inf'::DOUBLE END "
            f"ELSE ({num}) / ({den}) END")


_MODEL_SQL = f"""
WITH {q_segments.SLEEP_CHAIN_SQL},
m0 AS (SELECT patient_id, start_date, date, period_obs, time_in_bed AS ibp, minutes_snoring AS snoring_time,
              AWAKE, DEEP, REM, LIGHT, heart_rate AS hr_average, respiratory_rate AS rr_average, hr_min, rr_min,
              start_time, hr_max, rr_max, end_time, nb_awakenings, bed_time_period, time_out_of_bed AS obp,
              time_to_bed AS To_bed, wake_up_time AS Arise, nap_ibp FROM dailies),
m1 AS (SELECT *, {_ratio_sql("DEEP", "AWAKE + DEEP + REM + LIGHT")} AS deep_ratio,
              {_ratio_sql("AWAKE", "AWAKE + DEEP + REM + LIGHT")} AS awake_ratio,
              {_ratio_sql("REM", "AWAKE + DEEP + REM + LIGHT")} AS rem_ratio,
              {_ratio_sql("LIGHT", "AWAKE + DEEP + REM + LIGHT")} AS light_ratio,
              {_ratio_sql("nb_awakenings", "ibp + obp")} AS exit_ratio,
              greatest(0.0, least(10.0, round_even({_ratio_sql("obp * 60", "nb_awakenings")}, 0))) AS mean_obp,
              {_ratio_sql("obp", "ibp + obp")} AS obp_rate, CAST(CAST(start_date AS DATE) AS TIMESTAMP) AS night,
              avg(hr_average) OVER wh AS hm, stddev_samp(hr_average) OVER wh AS hs,
              avg(rr_average) OVER wr AS rm, stddev_samp(rr_average) OVER wr AS rs
       FROM m0
       WINDOW wh AS (PARTITION BY patient_id, hr_average IS NULL ORDER BY start_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
              wr AS (PARTITION BY patient_id, rr_average IS NULL ORDER BY start_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT patient_id, start_date, date, CAST(period_obs AS BIGINT) AS period_obs, round(ibp, 6) AS ibp,
       CAST(snoring_time AS BIGINT) AS snoring_time, round(AWAKE, 6) AS AWAKE, round(DEEP, 6) AS DEEP,
       round(REM, 6) AS REM, round(LIGHT, 6) AS LIGHT, round(hr_average, 6) AS hr_average,
       round(rr_average, 6) AS rr_average, round(hr_min, 6) AS hr_min, round(rr_min, 6) AS rr_min, start_time,
       round(hr_max, 6) AS hr_max, round(rr_max, 6) AS rr_max, end_time, CAST(nb_awakenings AS BIGINT) AS nb_awakenings,
       round(bed_time_period, 6) AS bed_time_period, round(greatest(0.0, least(600.0, obp * 60)), 6) AS obp,
       round(To_bed, 6) AS To_bed, round(Arise, 6) AS Arise, round(nap_ibp, 6) AS nap_ibp,
       round(deep_ratio, 6) AS deep_ratio, round(awake_ratio, 6) AS awake_ratio, round(rem_ratio, 6) AS rem_ratio,
       round(light_ratio, 6) AS light_ratio, round(exit_ratio, 6) AS exit_ratio, round(mean_obp, 6) AS mean_obp,
       round(obp_rate, 6) AS obp_rate, night,
       round(CASE WHEN hs IS NULL OR hs = 0 THEN NULL ELSE (hr_average - hm) / hs END, 6) AS hr_local_norm,
       round(CASE WHEN rs IS NULL OR rs = 0 THEN NULL ELSE (rr_average - rm) / rs END, 6) AS rr_local_norm
FROM m1
"""


@register("sleep_model", _MODEL_SQL, "D13", "SC18", "WN8", "FIL13")
def q_sleep_model(spark, sf):
    return round_doubles(pf.sleep_model(q_segments.sleep_dailies(spark, sf), ["patient_id"]))


# ---------------------------------------------------------------- physiology

# Fixed mapping of event types onto physiology sources for the physiology view of ``events``.
SOURCE_OF_EVENT = {"click": "raw_heart_rate", "view": "raw_body_weight", "purchase": "raw_body_mass_index",
                   "signup": "raw_oxygen_saturation", "error": "raw_body_temperature"}
_SRC_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCE_OF_EVENT.items()) + " END"


def physiology_view(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("patient_id"), map_strict("event_type", SOURCE_OF_EVENT).alias("source"),
                     F.col("ts").alias("start_date"), "value")


_PHYS_DAILIES_SQL = f"""
{q_segments.SLEEP_CHAIN_SQL},
ph AS (SELECT user_id AS patient_id, {_SRC_CASE} AS source, ts AS start_date, value FROM events
       WHERE user_id IS NOT NULL),
pm AS (SELECT patient_id, source, time_bucket(INTERVAL 1 day, start_date, INTERVAL 12 hours) AS start_date,
              avg(value) AS value FROM ph WHERE source IS NOT NULL GROUP BY ALL),
pg AS (SELECT patient_id, source, unnest(generate_series(lo, hi, INTERVAL 1 day)) AS start_date
       FROM (SELECT patient_id, source, min(start_date) lo, max(start_date) hi FROM pm GROUP BY ALL)),
pdense AS (SELECT pg.*, pm.value FROM pg LEFT JOIN pm USING (patient_id, source, start_date)),
wide AS (SELECT patient_id, start_date,
                {", ".join(f"max(value) FILTER (WHERE source = '{s}') AS {n}" for s, n in pf.PHYSIOLOGY_SOURCES.items())}
         FROM pdense GROUP BY ALL),
rm AS (SELECT patient_id, time_bucket(INTERVAL 1 day, start_date, INTERVAL 12 hours) AS start_date,
              avg(respiratory_rate) AS RR_rest, avg(heart_rate) AS HR_rest FROM dailies GROUP BY ALL),
rg AS (SELECT patient_id, unnest(generate_series(lo, hi, INTERVAL 1 day)) AS start_date
       FROM (SELECT patient_id, min(start_date) lo, max(start_date) hi FROM rm GROUP BY ALL)),
rest AS (SELECT rg.*, rm.RR_rest, rm.HR_rest FROM rg LEFT JOIN rm USING (patient_id, start_date)),
phys AS (SELECT wide.*, rest.RR_rest, rest.HR_rest FROM wide LEFT JOIN rest USING (patient_id, start_date))"""

_PHYS_COLS = [*pf.PHYSIOLOGY_SOURCES.values(), "RR_rest", "HR_rest"]


def physiology_dailies(spark, sf):
    return pf.physiology_dailies(physiology_view(spark, sf), q_segments.sleep_dailies(spark, sf), ["patient_id"])


@register("physiology_dailies", f"""
WITH {_PHYS_DAILIES_SQL}
SELECT patient_id, start_date, {", ".join(f"round({c}, 6) AS {c}" for c in _PHYS_COLS)} FROM phys
""", "AG9", "JN5", "D14")
def q_physiology_dailies(spark, sf):
    return round_doubles(physiology_dailies(spark, sf))


@register("physiology_weeklies", f"""
WITH {_PHYS_DAILIES_SQL},
w AS (SELECT patient_id, date_trunc('week', start_date) + INTERVAL 6 days AS start_date,
             {", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in _PHYS_COLS)}
      FROM phys GROUP BY ALL),
g AS (SELECT patient_id, unnest(generate_series(lo, hi, INTERVAL 7 days)) AS start_date
      FROM (SELECT patient_id, min(start_date) lo, max(start_date) hi FROM w GROUP BY patient_id))
SELECT g.patient_id, g.start_date,
       {", ".join(f"round({c}_mean, 6) AS {c}_mean, round({c}_std, 6) AS {c}_std" for c in _PHYS_COLS)}
FROM g LEFT JOIN w USING (patient_id, start_date)
""", "AG6", "D14")
def q_physiology_weeklies(spark, sf):
    return round_doubles(pf.weeklies(physiology_dailies(spark, sf), ["patient_id"]))


# ---------------------------------------------------------------- simple sleep tables

_SIMPLE_SQL = f"""
{q_segments.SLEEP_CHAIN_SQL},
sd AS (SELECT patient_id, time_bucket(INTERVAL 1 day, start_date, INTERVAL 12 hours) AS start_date,
              avg(heart_rate) AS hr, avg(respiratory_rate) AS br, sum(CAST(snoring AS DOUBLE)) AS snr,
              min(start_date) AS ttb, max(start_date) AS wup, count(*) / 60.0 AS tib
       FROM sleep WHERE CAST(start_date AS TIME) >= TIME '17:00:00' OR CAST(start_date AS TIME) <= TIME '11:00:00'
       GROUP BY ALL),
simple AS (SELECT patient_id, start_date, hr AS "Heart rate", br AS "Breathing rate", snr AS "Snoring",
                  (hour(ttb) * 3600 + minute(ttb) * 60 + second(ttb)) / 240.0 AS "Time to bed",
                  (hour(wup) * 3600 + minute(wup) * 60 + second(wup)) / 240.0 AS "Wake up time",
                  tib AS "Time in bed", (epoch_us(wup) - epoch_us(ttb)) / 3.6e9 - tib AS "Time out of bed"
           FROM sd WHERE hr IS NOT NULL AND br IS NOT NULL)"""


def sleep_simple(spark, sf):
    return pf.sleep_dailies_simple(q_segments.base_sleep(spark, sf), ["patient_id"])


@register("sleep_dailies_simple", f"""
WITH {_SIMPLE_SQL}
SELECT patient_id, start_date, {", ".join(f'round("{n}", 6) AS "{n}"' for n in pf.SIMPLE_NAMES)} FROM simple
""", "AG19", "D25", "FIL4", "SC1", "SC17")
def q_sleep_dailies_simple(spark, sf):
    return round_doubles(sleep_simple(spark, sf))


def _circ_sql(col: str) -> tuple[str, str]:
    a = f'radians("{col}")'
    x = f"degrees(atan2(sum(sin({a})), sum(cos({a}))))"
    r = f"least(1.0, sqrt(avg(sin({a})) ** 2 + avg(cos({a})) ** 2))"
    return (f"{x} - 360.0 * floor({x} / 360.0)", f"CASE WHEN {r} > 0 THEN degrees(sqrt(-2 * ln({r}))) END")


_LIN = [pf.SIMPLE_NAMES[i] for i in (0, 1, 2, 5, 6)]
_ANG = [pf.SIMPLE_NAMES[3], pf.SIMPLE_NAMES[4]]
_WK_AGGS = []
for _n in pf.SIMPLE_NAMES:
    if _n in _ANG:
        _m, _s = _circ_sql(_n)
        _WK_AGGS.append(f'{_m} AS "{_n}_mean", {_s} AS "{_n}_std"')
    else:
        _WK_AGGS.append(f'avg("{_n}") AS "{_n}_mean", stddev_samp("{_n}") AS "{_n}_std"')


@register("sleep_weeklies", f"""
WITH {_SIMPLE_SQL},
w AS (SELECT patient_id, date_trunc('week', start_date) + INTERVAL 6 days AS start_date, {", ".join(_WK_AGGS)}
      FROM simple GROUP BY ALL),
g AS (SELECT patient_id, unnest(generate_series(lo, hi, INTERVAL 7 days)) AS start_date
      FROM (SELECT patient_id, min(start_date) lo, max(start_date) hi FROM w GROUP BY patient_id))
SELECT g.patient_id, g.start_date,
       {", ".join(f'round("{n}_mean", 6) AS "{n}_mean", round("{n}_std", 6) AS "{n}_std"' for n in pf.SIMPLE_NAMES)}
FROM g LEFT JOIN w USING (patient_id, start_date)
""", "AG18", "AG16", "AG17", "D25")
def q_sleep_weeklies(spark, sf):
    return round_doubles(pf.sleep_weeklies(sleep_simple(spark, sf), ["patient_id"]))
