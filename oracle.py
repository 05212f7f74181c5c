"""DuckDB SQL for the registered queries, written against the raw ``events`` table.

Doubles are rounded to 6 digits on both sides, because engines add in different orders.
"""

from __future__ import annotations

from vitalgrid.params import GOALS, KPIS as KPI_ROWS

DAY = "ts::date"
WAKE_DAY = "(ts + interval 6 hour)::date"

# one CTE per record type, each a plain aggregate over events
CTES = {
    "hr": f"""select user_id, {DAY} as day, min((48 + event_id % 90)::double) as resting_hr,
        avg((48 + event_id % 90)::double) as hr_avg
        from events where event_type = 'view' group by 1, 2""",
    "st": f"""select user_id, {DAY} as day, max((4000 + event_id % 11001)::double) as steps,
        max((event_id % 120)::double) as active_minutes, 0::double as calories
        from events where event_type in ('view', 'click') group by 1, 2""",
    "stress": f"""select user_id, {DAY} as day, avg((event_id % 101)::double) as stress_avg
        from events where event_type = 'click' group by 1, 2""",
    "spo2": f"""select user_id, {DAY} as day, min((90 + event_id % 10)::double) as spo2_min,
        avg((90 + event_id % 10)::double) as spo2_avg
        from events where event_type = 'signup' group by 1, 2""",
    "body": f"""select user_id, {DAY} as day, avg(70e0 + (event_id % 200) / 10e0) as weight,
        avg(15e0 + (event_id % 90) / 10e0) as body_fat
        from events where event_type = 'signup' and event_id % 3 = 0 group by 1, 2""",
    "sl_rows": f"""select user_id, {WAKE_DAY} as day, (360 + event_id % 141)::double as minutes,
        (70 + event_id % 27)::double as eff, (55 + event_id % 38)::double as score,
        (epoch_us(ts + to_microseconds((360 + event_id % 141) * 30000000)) % 86400000000)
        / 1e6 / 3600e0 - 18e0 as h
        from events where event_type = 'error'""",
    "sl": """select user_id, day, sum(minutes) as sleep_minutes, avg(eff) as sleep_efficiency,
        max(score) as sleep_score, avg(((h % 24e0) + 24e0) % 24e0) as sleep_midpoint
        from sl_rows group by 1, 2""",
    "sg_min": f"""select user_id, {WAKE_DAY} as day, sum((20 + event_id % 70)::double) as total,
        coalesce(sum((20 + event_id % 70)::double) filter (event_id % 5 = 0), 0e0) as awake,
        coalesce(sum((20 + event_id % 70)::double) filter (event_id % 5 in (1, 4)), 0e0) as light,
        coalesce(sum((20 + event_id % 70)::double) filter (event_id % 5 = 2), 0e0) as deep,
        coalesce(sum((20 + event_id % 70)::double) filter (event_id % 5 = 3), 0e0) as rem
        from events group by 1, 2""",
    "sg": """select user_id, day,
        round_even(awake / total * 100e0 * 10e0, 0) / 10e0 as awake_pct,
        round_even(light / total * 100e0 * 10e0, 0) / 10e0 as light_pct,
        round_even(deep / total * 100e0 * 10e0, 0) / 10e0 as deep_pct,
        round_even(rem / total * 100e0 * 10e0, 0) / 10e0 as rem_pct from sg_min""",
    "all_days": """select user_id, day from hr union all select user_id, day from st
        union all select user_id, day from stress union all select user_id, day from spo2
        union all select user_id, day from body union all select user_id, day from sl
        union all select user_id, day from sg""",
    "grid": """select user_id, unnest(generate_series(lo, hi, interval 1 day))::date as day
        from (select user_id, min(day) as lo, max(day) as hi from all_days group by 1)""",
    "rest": """select user_id, coalesce(median(resting_hr), 60e0) as hr_rest from hr group by 1""",
    "ex_rows": f"""select e.user_id, e.ts, e.event_id, {DAY.replace('ts', 'e.ts')} as day,
        ((1200 + event_id % 3000) * 1000)::double / 60000e0 as minutes,
        (90 + event_id % 80)::double as mean_hr, coalesce(hr_rest, 60e0) as hr_rest
        from events e left join rest using (user_id) where event_type = 'purchase'""",
    "ex_frac": """select *, least(1e0, greatest(0e0, (mean_hr - hr_rest) / (190e0 - hr_rest))) as f
        from ex_rows""",
    "ex": "select *, minutes * f * (0.64e0 * exp(1.92e0 * f)) as trimp from ex_frac",
    "ld": "select user_id, day, sum(trimp) as load from ex group by 1, 2",
    "base": """select g.user_id, g.day, resting_hr, hr_avg, steps, active_minutes, calories,
        sleep_minutes, sleep_efficiency, sleep_score, sleep_midpoint,
        awake_pct, light_pct, deep_pct, rem_pct, stress_avg, spo2_min, spo2_avg, weight, body_fat,
        null::double as skeletal_muscle, null::double as muscle_mass, null::double as bmi,
        coalesce(load, 0e0) as load
        from grid g left join hr using (user_id, day) left join st using (user_id, day)
        left join sl using (user_id, day) left join sg using (user_id, day)
        left join stress using (user_id, day) left join spo2 using (user_id, day)
        left join body using (user_id, day) left join ld using (user_id, day)""",
    "roll": """select *,
        avg(load) over (w rows between 6 preceding and current row) as load_acute,
        avg(load) over (w rows between 27 preceding and current row) as load_chronic,
        sum(480e0 - sleep_minutes) over (w rows between 13 preceding and current row) as sleep_debt,
        case when count(sleep_midpoint) over (w rows between 6 preceding and current row) >= 3 then
          stddev_samp(sleep_midpoint) over (w rows between 6 preceding and current row)
          end as sleep_regularity,
        case when count(resting_hr) over (w rows between 29 preceding and current row) >= 3 then
          median(resting_hr) over (w rows between 29 preceding and current row) end as med,
        last_value(weight ignore nulls) over (w rows unbounded preceding) as weight_ffill
        from base window w as (partition by user_id order by day)""",
    "fill": """select *, case when load_chronic <> 0 then load_acute / load_chronic end as acwr,
        first_value(med ignore nulls) over
          (partition by user_id order by day rows between current row and unbounded following)
          as rhr_baseline,
        weight_ffill - lag(weight_ffill, 7) over (partition by user_id order by day)
          as weight_delta_7d,
        weight_ffill - lag(weight_ffill, 30) over (partition by user_id order by day)
          as weight_delta_30d,
        bool_or(resting_hr is not null) over (partition by user_id) as has_rhr,
        bool_or(sleep_score is not null) over (partition by user_id) as has_score,
        bool_or(sleep_minutes is not null) over (partition by user_id) as has_minutes,
        bool_or(stress_avg is not null) over (partition by user_id) as has_stress,
        bool_or(load > 0) over (partition by user_id) as has_load
        from roll""",
    "scored": """select *,
        case when rhr_baseline is not null and resting_hr is not null then
          least(100e0, greatest(0e0, 50e0 + (rhr_baseline - resting_hr) * 4e0)) end as rhr_score,
        case when has_score then
          case when sleep_score is not null then least(100e0, greatest(0e0, sleep_score)) end
          when sleep_minutes is not null then
          least(100e0, greatest(0e0, sleep_minutes / 480e0 * 100e0)) end as sleep_score_c,
        case when stress_avg is not null then
          least(100e0, greatest(0e0, 100e0 - stress_avg)) end as stress_score,
        case when acwr is not null then least(100e0, greatest(0e0,
          100e0 - greatest(0e0, 0.8e0 - acwr) * 250e0 - greatest(0e0, acwr - 1.3e0) * 120e0))
          end as acwr_score,
        0e0 + case when has_rhr then 0.3e0 else 0e0 end
          + case when has_score or has_minutes then 0.35e0 else 0e0 end
          + case when has_stress then 0.2e0 else 0e0 end
          + case when has_load then 0.15e0 else 0e0 end as wsum
        from fill""",
    "metrics": """select *, case when wsum > 0 then round_even((0e0
          + case when has_rhr then rhr_score * (0.3e0 / wsum) else 0e0 end
          + case when has_score or has_minutes then sleep_score_c * (0.35e0 / wsum) else 0e0 end
          + case when has_stress then stress_score * (0.2e0 / wsum) else 0e0 end
          + case when has_load then acwr_score * (0.15e0 / wsum) else 0e0 end)
          * 10e0, 0) / 10e0 end as readiness
        from scored""",
}

METRICS_COLUMNS = (
    "resting_hr", "hr_avg", "steps", "active_minutes", "calories",
    "sleep_minutes", "sleep_efficiency", "sleep_score", "sleep_midpoint",
    "awake_pct", "light_pct", "deep_pct", "rem_pct", "stress_avg", "spo2_min", "spo2_avg",
    "weight", "body_fat", "skeletal_muscle", "muscle_mass", "bmi",
    "load", "load_acute", "load_chronic", "acwr", "sleep_debt", "sleep_regularity",
    "weight_ffill", "weight_delta_7d", "weight_delta_30d", "rhr_baseline",
    "rhr_score", "sleep_score_c", "stress_score", "acwr_score", "readiness",
)
CORRELATED = (
    "readiness", "resting_hr", "sleep_minutes", "sleep_debt", "stress_avg", "load", "steps", "acwr")
KPIS = ("resting_hr", "sleep_minutes", "steps", "load", "stress_avg", "readiness")


def _with(last: str, select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` after the CTEs up to ``last`` and the extra ones."""
    names = list(CTES)
    ctes = {n: CTES[n] for n in names[: names.index(last) + 1]} | (extra or {})
    return "with " + ", ".join(f"{n} as ({sql})" for n, sql in ctes.items()) + " " + select


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


def _range(days: int) -> dict[str, str]:
    return {"win": f"""select * from (select *, max(day) over (partition by user_id) as newest
        from metrics) where day >= newest - {days - 1}"""}


def _long(table: str, columns, where: str = "true") -> str:
    return " union all ".join(
        f"select user_id, day, '{c}' as key, {c} as v from {table} where {where}" for c in columns)


def _map(column: str, values: dict) -> str:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in values.items())
    return f"case {column} {cases} end"


SPAN = "(day(ts) between 5 and 20)"
CARDS = """select l.user_id, l.as_of, l.key, {texts}, round(l.value, 6) as value,
            round(l.value - case when p.n >= 8 then p.at8 else p.oldest end, 6) as delta
            from last_values l left join (
              select user_id, key, max(pos) as n, max(v) filter (pos = 8) as at8,
                arg_max(v, pos) as oldest from pts group by 1, 2) p
              on l.user_id = p.user_id and l.key = p.key"""
KPI_TEXTS = ", ".join(
    f"{_map('l.key', {k[0]: k[i] for k in KPI_ROWS})} as {n}" for i, n in ((1, "label"), (2, "unit"), (3, "better")))

JUNK_TIME = """case event_id % 8 when 3 then null when 4 then null when 5 then null
    when 6 then date_trunc('day', ts)::timestamp when 7 then null
    else date_trunc('millisecond', ts)::timestamp end"""
# times as Spark casts them to text: without zeros at the end of the fraction
TIME_CAST = "regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '[.]?0+$', '')"
# durations of ten million and more are shown with an exponent by neither engine alike; ours are below
DURATION_TEXT = "((1200 + event_id % 3000) * 1000)::double::varchar"
TIME_TEXT = "'%Y-%m-%d %H:%M:%S.%g'"


def oracle_sql() -> dict[str, str]:
    pairs = " union all ".join(
        f"""select user_id, '{x}' as x, '{y}' as y, case when count(*) filter
            ({x} is not null and {y} is not null) >= 2 then corr({y}, {x}) end as v
            from win group by user_id"""
        for x in CORRELATED for y in CORRELATED)
    kpi_rank = {
        **_range(30),
        "pts": f"""select *, row_number() over (partition by user_id, key order by day desc) as pos
            from ({_long('win', KPIS)}) where v is not null""",
    }
    last_values = {"last_values": " union all ".join(
        f"""select user_id, day as as_of, '{c}' as key, {c} as value
            from (select *, max(day) over (partition by user_id) as newest from metrics)
            where day = newest""" for c in KPIS)}
    series = f"""select user_id, strftime(day, '%Y-%m-%d') as day,
            {_r("readiness", "resting_hr", "rhr_baseline", "hr_avg", "sleep_minutes", "sleep_debt",
                "sleep_score", "sleep_regularity")},
            round(deep_pct / 100e0 * sleep_minutes / 60e0, 6) as deep_h,
            round(rem_pct / 100e0 * sleep_minutes / 60e0, 6) as rem_h,
            round(light_pct / 100e0 * sleep_minutes / 60e0, 6) as light_h,
            round(awake_pct / 100e0 * sleep_minutes / 60e0, 6) as awake_h,
            {_r("stress_avg", "spo2_min", "steps", "load", "load_acute", "load_chronic", "acwr",
                "weight_ffill", "body_fat")} from """
    workouts = """select user_id, strftime(ts, '%Y-%m-%d') as date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as start_time,
            case event_id % 8 when 0 then 'Chôdza' when 1 then 'Beh' when 2 then 'Bicykel'
              when 3 then 'Túra' when 4 then 'Plávanie' when 5 then 'Posilňovňa'
              else 'Tréning' end as type,
            round_even(minutes * 10e0, 0) / 10e0 as duration_min,
            round_even((1000 + event_id % 9000)::double / 1000e0 * 100e0, 0) / 100e0 as distance_km,
            round_even(minutes / ((1000 + event_id % 9000)::double / 1000e0) * 100e0, 0) / 100e0
              as pace_min_km,
            (event_id % 700)::double as calorie,
            (90 + event_id % 80)::bigint as mean_hr, (110 + event_id % 80)::bigint as max_hr,
            round_even(trimp * 10e0, 0) / 10e0 as trimp
            from (select *, max(ts) over (partition by user_id) as newest from ex)
            where ts >= newest - interval """
    goal_rows = """select user_id, key, cur,
            case key when 'steps' then 10000e0 when 'sleep_minutes' then 480e0
              when 'readiness' then 80e0 else 1e0 end as target,
            case when cur is null then null when key = 'acwr'
              then greatest(0e0, 1e0 - abs(cur - 1e0))
              else least(1.5e0, cur / case key when 'steps' then 10000e0
                when 'sleep_minutes' then 480e0 else 80e0 end) end as progress
            from (""" + " union all ".join(
                f"select user_id, '{c}' as key, avg({c}) as cur from win group by 1"
                for c in ("steps", "sleep_minutes", "readiness", "acwr")) + ")"
    goal_texts = ", ".join(
        f"{_map('key', {g[0]: g[i] for g in GOALS})} as {n}" for i, n in ((1, "label"), (3, "unit")))
    return {
        "readiness_daily": _with("metrics", f"select user_id, day, {_r(*METRICS_COLUMNS)} from metrics"),
        "daily_resting_hr": _with("hr", f"select user_id, day, {_r('resting_hr', 'hr_avg')} from hr"),
        "daily_steps": _with("st", "select user_id, day, steps, active_minutes, calories from st"),
        "daily_stress": _with("stress", f"select user_id, day, {_r('stress_avg')} from stress"),
        "daily_spo2": _with("spo2", f"select user_id, day, {_r('spo2_min', 'spo2_avg')} from spo2"),
        "body_series": _with("body", f"""select user_id, day, {_r('weight', 'body_fat')},
            null::double as skeletal_muscle, null::double as muscle_mass, null::double as bmi
            from body"""),
        "nightly_sleep": _with("sl", f"""select user_id, day,
            {_r('sleep_minutes', 'sleep_efficiency', 'sleep_score', 'sleep_midpoint')} from sl"""),
        "nightly_stages": _with("sg", f"""select user_id, day,
            {_r('awake_pct', 'light_pct', 'deep_pct', 'rem_pct')} from sg"""),
        "dense_grid": _with("base", f"select user_id, day, {_r('resting_hr', 'steps')} from base"),
        "resting_median": _with("rest", "select user_id, round(hr_rest, 6) as hr_rest from rest"),
        "daily_load": _with("ld", f"select user_id, day, {_r('load')} from ld"),
        "acwr": _with("fill", f"""select user_id, day,
            {_r('load', 'load_acute', 'load_chronic', 'acwr')} from fill"""),
        "sleep_debt": _with("fill", f"select user_id, day, {_r('sleep_debt')} from fill"),
        "sleep_regularity": _with("fill", f"select user_id, day, {_r('sleep_regularity')} from fill"),
        "rhr_baseline": _with("fill", f"select user_id, day, {_r('rhr_baseline')} from fill"),
        "weight_trend": _with("fill", f"""select user_id, day,
            {_r('weight_ffill', 'weight_delta_7d', 'weight_delta_30d')} from fill"""),
        "readiness_scores": _with("metrics", f"""select user_id, day,
            {_r('rhr_score', 'sleep_score_c', 'stress_score', 'acwr_score', 'readiness')}
            from metrics"""),
        "readiness_profiles": _with("ex_rows", """select user_id, day, round(sum(
              case when user_id % 3 = 0 then minutes * f * (0.86e0 * exp(1.67e0 * f))
              else minutes * f * (0.64e0 * exp(1.92e0 * f)) end), 6) as load
            from own group by 1, 2""", {
            "own": """select *, least(1e0, greatest(0e0, (mean_hr - rest_hr)
                / (180e0 + user_id % 20 - rest_hr))) as f
                from (select *, case when user_id % 2 = 0 then (50 + user_id % 10)::double
                      else hr_rest end as rest_hr from ex_rows)"""}),
        "summary_kpis": _with("metrics", CARDS.format(texts=KPI_TEXTS), {**kpi_rank, **last_values}),
        "summary_cards": _with("metrics", "select * exclude (as_of), "
            + " ".join(["case key", *[f"when '{k}' then {i}" for i, k in enumerate(KPIS)], "end"]) + " as pos from ("
            + CARDS.format(texts=KPI_TEXTS) + ")", {
                "pts": kpi_rank["pts"].replace("from win", "from metrics"), **last_values}),
        "summary_spark": _with("metrics", """select user_id, key, round_even(v * 100e0, 0) / 100e0 as v,
            (row_number() over (partition by user_id, key order by day) - 1)::int as pos
            from pts where pos <= 14""", kpi_rank),
        "kpi_points": _with("metrics", """select user_id, key, pos, day, round(v, 6) as v
            from pts where pos <= 14""", kpi_rank),
        "timeseries": _with("metrics", series + "win", _range(30)),
        "timeseries_all": _with("metrics", series + "metrics"),
        "metrics_tail": _with("metrics", f"""select user_id, day,
            {", ".join(f"round_even({c} * 10e0, 0) / 10e0 as {c}" for c in
                       ("resting_hr", "sleep_minutes", "sleep_debt", "stress_avg", "load", "acwr",
                        "readiness"))}
            from win""", _range(7)),
        "workouts": _with("ex", workouts + "89 day"),
        "workouts_week": _with("ex", workouts + "6 day"),
        "workout_spans": _with("ld", f"select user_id, day, {_r('load')} from ld"),
        "load_outside_days": "with " + ", ".join(f"{n} as ({q})" for n, q in {
            "hr": CTES["hr"].replace("event_type = 'view'", f"event_type = 'view' and {SPAN}"),
            **{n: CTES[n] for n in ("rest", "ex_rows", "ex_frac", "ex", "ld")},
            "grid": """select user_id, unnest(generate_series(lo, hi, interval 1 day))::date as day
                from (select user_id, min(day) as lo, max(day) as hi from hr group by 1)""",
        }.items()) + """ select user_id, day, round(coalesce(load, 0e0), 6) as load
            from grid left join ld using (user_id, day)""",
        "sleep_without_scores": _with("base", f"""select user_id, day, {_r('sleep_minutes')},
            case when user_id % 2 = 0 then sleep_score end as sleep_score,
            round(case when user_id % 2 = 0 then case when sleep_score is not null then least(100e0, sleep_score) end
              when sleep_minutes is not null then least(100e0, sleep_minutes / 480e0 * 100e0) end, 6)
              as sleep_score_c from base"""),
        "time_choice": """with c as (select *, user_id % 2 = 0 and event_id % 3 = 0 as starts
              from events where event_type = 'click'),
            p as (select *, bool_or(starts) over (partition by user_id) as has from c)
            select user_id, case when has then ts::date else (ts + interval 1 day)::date end as day,
              round(avg((event_id % 101)::double), 6) as stress_avg
            from p where starts or not has group by 1, 2""",
        "column_names": """select event_id, (generate_subscripts(names, 1) - 1)::int as pos, unnest(names) as name
            from (select event_id, case event_id % 3
              when 0 then ['start_time', 'a_time', 'Value', 'x_value', 'p' || (event_id % 50) || '_id']
              when 1 then ['stage', 'Stage_2', 'stage_3', 'user_id_2', 'export_ts_2', 'STAGE_4']
              else ['time', '', 'value', 'z'] end as names from events)""",
        "missing_table": "select user_id, count(*) as n_events, 0::bigint as n_workouts from events group by 1",
        "correlations": _with("metrics", f"""select user_id, x, y,
            round(case when isnan(v) then null else v end, 6) as v from ({pairs})""", _range(90)),
        "sleep_next_day": _with("metrics", """select user_id, day,
            round_even(sleep_minutes / 60e0 * 100e0, 0) / 100e0 as sleep_h, nxt as next_readiness
            from (select *, lead(readiness) over (partition by user_id order by day) as nxt from win)
            where sleep_minutes is not null and nxt is not null""", _range(90)),
        "correlations_shown": _with("metrics", f"""select user_id, x, y,
            round_even(case when isnan(v) then null else v end * 100e0, 0) / 100e0 + 0e0 as v
            from ({pairs})""", {"win": "select * from metrics"}),
        "goals": _with("metrics", f"""select user_id, key, {goal_texts}, round(cur, 6) as current, target,
            round(progress, 6) as progress from ({goal_rows})""", _range(7)),
        "goals_shown": _with("metrics", f"""select user_id, key, {goal_texts},
            round_even(cur * 10e0, 0) / 10e0 as current, target,
            round_even(progress * 100e0, 0) / 100e0 as progress from ({goal_rows})""", _range(7)),
        "steps_streak": _with("metrics", """select m.user_id,
            count(*) filter (missed is null or day > missed) as steps_streak
            from metrics m join (select user_id,
              max(day) filter (not coalesce(steps >= 10000, false)) as missed
              from metrics group by 1) l on m.user_id = l.user_id group by 1"""),
        "summary_components": _with("metrics", f"""select user_id, day as as_of,
            {_r('readiness', 'rhr_score', 'sleep_score_c', 'stress_score', 'acwr_score')}
            from (select *, max(day) over (partition by user_id) as newest from metrics)
            where day = newest"""),
        "dashboard_bands": _with("metrics", """select user_id, day,
            case when readiness is null then '–' when readiness >= 75 then 'Výborné zotavenie'
              when readiness >= 55 then 'Dobré zotavenie' when readiness >= 40 then 'Priemerné'
              else 'Nízke — oddýchni si' end as status,
            case when acwr is null then '–' when acwr < 0.8e0 then 'under'
              when acwr <= 1.3e0 then 'sweet spot' when acwr <= 1.5e0 then 'above'
              else 'overreach' end as acwr_band,
            case when sleep_minutes is null then '–' else
              floor(floor(sleep_minutes + 0.5e0) / 60)::bigint || ':' ||
              lpad((floor(sleep_minutes + 0.5e0)::bigint % 60)::varchar, 2, '0') end as slept
            from metrics"""),
        "kpi_direction": _with("metrics", """select user_id, day,
            case when d is null or abs(d) <= 0.5e0 then 'flat' when d < 0 then 'up' else 'down' end
              as resting_hr,
            case when s is null or abs(s) <= 0.5e0 then 'flat' when s > 0 then 'up' else 'down' end
              as steps,
            'flat' as load
            from (select *, resting_hr - lag(resting_hr) over w as d, steps - lag(steps) over w as s
                  from metrics window w as (partition by user_id order by day))"""),
        "clean_times": f"""select event_id, strftime({JUNK_TIME}, {TIME_TEXT}) as parsed,
            {JUNK_TIME}::date as day, ({JUNK_TIME} + interval 6 hour)::date as wake_day from events""",
        "clean_numbers": """select event_id, case event_id % 9 when 3 then null when 4 then null
            when 5 then null when 6 then null when 7 then (event_id * 1000)::double
            else event_id::double + 0.5e0 end as parsed from events""",
        "stage_names": """select event_id, case event_id % 7 when 1 then 'awake' when 3 then 'deep'
            when 4 then 'rem' when 6 then 'rem' else 'light' end as stage from events""",
        "keep_last_dedup": """select user_id, ts::date as day,
            max(event_id) as event_id, arg_max(value, event_id) as value,
            arg_max(event_type, event_id) as event_type
            from events group by 1, 2""",
        "keep_last_null_key": """select user_id, case when event_id % 3 > 0 then ts::date end as day,
            max(event_id) as event_id from events group by 1, 2""",
        "union_by_name": """select user_id, event_id, (event_id % 101)::double as score,
            null::double as spo2 from events where event_type = 'click' union all
            select user_id, event_id, null, (90 + event_id % 10)::double
            from events where event_type = 'signup'""",
        "first_filled_table": """select user_id, event_id, value from events
            where event_type = 'click' and user_id % 3 = 0
            union all select user_id, event_id, value from events
            where event_type = 'view' and user_id not in
              (select user_id from events where event_type = 'click' and user_id % 3 = 0)""",
        "candidate_choice": """select user_id, ts::date as day,
            max(case when user_id % 2 = 0 then
              case when event_id % 4 = 0 then (event_id % 5000)::double end
              else (event_id % 7000)::double end) as steps,
            0::double as active_minutes, 0::double as calories
            from events group by 1, 2""",
        "person_tables": """select user_id, ts::date as day, max(event_id % 5000)::double as steps,
            0::double as active_minutes, 0::double as calories
            from events where event_type = 'click' and user_id % 3 = 0 group by 1, 2
            union all select user_id, ts::date, max(event_id % 7000)::double, 0, 0
            from events where event_type = 'view' and user_id not in
              (select user_id from events where event_type = 'click' and user_id % 3 = 0)
            group by 1, 2""",
        "json_decode": """select event_id, case when event_id % 5 = 1 then null when event_id % 5 = 2 then null
            else '{"k":' || json_extract_string(props, '$.k') || '}' end as json from events""",
        "table_listing": " union all ".join(
            f"select '{t}' as table_name, count(*) as n_rows, count(*) filter (user_id % 7 = 0) as n_unowned, '{c}' as columns from events where {w}" for t, w, c in (
                ("heart_rate", "event_type = 'view'", "user_id,start_time,bpm"),
                ("stress", "event_type = 'click'", "user_id,start_time,score"),
                ("spo2", "event_type = 'signup'", "user_id,start_time,spo2"),
                ("exercise", "event_type = 'purchase'",
                 "user_id,start_time,duration,mean_hr,max_hr,distance,calorie,exercise_type"),
                ("body_composition", "event_type = 'signup' and event_id % 3 = 0",
                 "user_id,start_time,weight,body_fat"),
                ("sleep", "event_type = 'error'", "user_id,start_time,end_time,score,efficiency"),
                ("sleep_stage", "true", "user_id,start_time,end_time,stage"),
                ("steps_daily", "event_type in ('view', 'click')", "user_id,day_time,steps,active_time"))),
        "profile": " union all ".join(
            f"""select '{t}' as table_name, '{c}' as column_name, count(*) as n_rows,
                count(*) as n_filled, {'count(*)' if c == 'start_time' else 'null::bigint'} as n_times,
                (select string_agg(v, '|' order by event_id) from (
                   select event_id, {x} as v from events where {w} order by event_id limit 3)) as samples,
                {f"(select string_agg(v, '|' order by event_id) from (select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as v from events where {w} order by event_id limit 2))" if c == 'start_time' else "''"} as times
                from events where {w}""" for t, w, cs in (
                ("sleep_stage", "true", {"start_time": TIME_CAST, "stage": "(1 + event_id % 5)::double::varchar"}),
                ("heart_rate", "event_type = 'view'", {
                    "start_time": TIME_CAST, "bpm": "(48 + event_id % 90)::double::varchar"}),
                ("exercise", "event_type = 'purchase'", {
                    "start_time": TIME_CAST, "duration": DURATION_TEXT,
                    "mean_hr": "(90 + event_id % 80)::double::varchar", "calorie": "(event_id % 700)::double::varchar"}),
                ("stress", "event_type = 'click'", {
                    "start_time": TIME_CAST, "score": "(event_id % 101)::double::varchar"})) for c, x in cs.items()),
        "blob_lookup": """select event_id, case event_id % 6
            when 0 then '{"k":1,"u":' || user_id || '}' when 1 then '{"k":1,"u":' || user_id || '}'
            when 2 then '{"k":3}' when 5 then '{"k":' || json_extract_string(props, '$.k') || '}' end as cell_json
            from events""",
        "ingest_persons": f"""select user_id::varchar as user_id, '20240131120000' as export_ts,
            'com.samsung.shealth.tracker.heart_rate' as datatype_id, '7' as version,
            (count(*) + count(*) filter (event_id % 10 = 0))::bigint as n_rows
            from events where event_type = 'view' group by 1
            union all select user_id::varchar, '20240131120000', 'com.samsung.shealth.sleep_combined', '1', count(*)
            from events where event_type = 'error' group by 1""",
        "ingest_heart_rate": f"""select user_id, strftime(date_trunc('millisecond', ts), {TIME_TEXT}) as start_time,
            arg_max((48 + event_id % 90)::double, event_id) as bpm,
            'a, ' || chr(10) || ' b' as comment,
            arg_max('{{"k":' || json_extract_string(props, '$.k') || '}}', event_id) as binning_data_json
            from events where event_type = 'view' group by 1, 2""",
        "ingest_sleep_nights": f"""select user_id, {WAKE_DAY.replace('ts', "date_trunc('millisecond', ts)")} as day,
            sum((360 + event_id % 141)::double) as sleep_minutes,
            round(avg(case when event_id % 7 > 0 then (70 + event_id % 27)::double end), 9)
              as sleep_efficiency,
            max((55 + event_id % 38)::double) as sleep_score,
            round(avg((((epoch_us(ts) // 1000 % 86400000) / 3600000e0 - 18e0) % 24e0 + 24e0) % 24e0), 9) as sleep_midpoint
            from events where event_type = 'error' group by 1, 2""",
        "ingest_report": """select 'heart_rate' as table_name, count(distinct
              (user_id, date_trunc('millisecond', ts))) as row_count,
              count(*) filter (event_id % 40 = 0) as wide_rows from events where event_type = 'view'
            union all select 'sleep_combined', count(*), 0 from events where event_type = 'error'""",
        "ingest_run": """select 'heart_rate' as table_name, count(distinct
              (user_id, date_trunc('millisecond', ts))) as row_count,
              count(*) filter (event_id % 40 = 0) as wide_rows,
              count(distinct (user_id, date_trunc('millisecond', ts))) as stored_rows,
              'user_id,export_ts,start_time,bpm,comment,binning_data,binning_data_json' as columns
            from events where event_type = 'view'
            union all select 'sleep_combined', count(*), 0, count(*),
              'user_id,export_ts,start_time,sleep_score,efficiency,sleep_duration' from events where event_type = 'error'""",
        "ingest_refresh": """
            with late as (select count(distinct user_id) as persons from events
              where user_id % 3 = 0 and event_type in ('view', 'error')),
            readings as (select user_id, date_trunc('millisecond', ts) as t, arg_max((48 + event_id % 90)::double, event_id) as bpm
              from events where event_type = 'view' group by 1, 2)
            select 'heart_rate' as table_name, any_value(persons) as persons, count(*) as n_rows,
              'user_id,export_ts,start_time,bpm,comment,binning_data,binning_data_json' as columns,
              sum(bpm) as bpm, count(distinct user_id) as owners from readings, late
            union all select 'sleep_combined', any_value(persons), count(*),
              'user_id,export_ts,start_time,sleep_score,efficiency,sleep_duration', null, null
            from events, late where event_type = 'error'""",
        "ingest_files": f"""
            with cells as (
              select user_id, 'heart_rate' as kind, unnest([
                case when event_id % 10 = 0 then [strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), '1', 'first', '[]'] end,
                [strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), (48 + event_id % 90)::varchar, 'a, ' || chr(10) || ' b', props]
                  || case when event_id % 40 = 0 then ['a cell too many'] else [] end]) as c
              from events where event_type = 'view'
              union all select user_id, 'sleep', [(epoch_us(ts) // 1000)::varchar, (55 + event_id % 38)::varchar,
                case when event_id % 7 = 0 then 'NaN' else (70 + event_id % 27)::varchar end, (360 + event_id % 141)::varchar]
              from events where event_type = 'error')
            select user_id::varchar as user_id, '20240131120000' as export_ts,
              case kind when 'sleep' then 'com.samsung.shealth.sleep_combined'
                else 'com.samsung.shealth.tracker.heart_rate' end as datatype_id,
              case kind when 'sleep' then '1' else '7' end as version, part, sum(n)::bigint as n_rows,
              sum(cells)::bigint as n_cells, sum(letters)::bigint as n_letters from (
                select user_id, kind, 'data' as part, count(*) as n, sum(len(c)) as cells, sum(length(array_to_string(c, '|'))) as letters
                from cells where c is not null group by 1, 2
                union all select distinct user_id, kind, 'header', 1, 4, case kind when 'sleep' then
                  length('com.samsung.health.sleep_combined.') * 4 + length('start_time|sleep_score|efficiency|sleep_duration')
                  else length('com.samsung.health.heart_rate.') * 4 + length('start_time|heart_rate|comment|binning_data') end from cells)
            group by all""",
        "ingest_long_cells": """
            with texts as (select user_id, string_agg(props, ',' || chr(10) order by event_id, props) as text from events group by 1)
            select user_id, unnest([user_id::varchar, text, 'end']) as cell from texts""",
        "range_of_stored_metrics": _with("fill", """select user_id, day, round(resting_hr, 6) as resting_hr, steps
            from (select *, max(day) over (partition by user_id) as newest from fill) where day >= newest - 6"""),
    }
