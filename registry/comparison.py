from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import CATEGORICAL, NUMERIC, REAL, drifted_lines, real_lines, table
from tabloom.operators import comparison as c
from tabloom.operators.encoding import one_hot
from tabloom.operators.two_sample import rank_statistics, two_sample_tests


def _both(spark, sf):
    return real_lines(spark, sf), drifted_lines(spark, sf)


def _round(df, digits=6):
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"})


def drift_numeric(spark, sf):
    return _round(c.numeric_drift(*_both(spark, sf), NUMERIC).drop("position"), 4)


def drift_categorical(spark, sf):
    return _round(c.categorical_drift(*_both(spark, sf), CATEGORICAL))


def frequencies(spark, sf):
    return _round(c.category_frequencies(*_both(spark, sf), CATEGORICAL).drop("in_real", "in_synthetic"))


def align(spark, sf):
    """Proportions of two tables with different categories, joined over their union."""
    real, syn = _both(spark, sf)
    return _round(
        c.align_frequencies(
            c.proportions(real.where("l_returnflag <> 'R'"), "l_returnflag"), c.proportions(syn.where("l_returnflag <> 'A'"), "l_returnflag")
        )
    )


def drift_one_hot(spark, sf):
    """The second table holds one-hot columns; the first one categories it lacks."""
    real, syn = _both(spark, sf)
    dummies = one_hot(syn.select("l_returnflag", "l_quantity"), ["l_returnflag"])
    return _round(c.categorical_drift(real, dummies, ["l_returnflag", "l_linestatus"]))


def drift_target(spark, sf):
    real, syn = _both(spark, sf)
    return _round(c.frequency_drift(c.target_frequencies(real, syn, "l_linenumber")))


def _table(spark, sf, **options):
    real, syn = _both(spark, sf)
    return c.comparison_table(
        real, syn, numeric=NUMERIC, categorical=CATEGORICAL, target="l_linenumber", synthetic_target=syn, **options
    )


def comparison_table(spark, sf):
    return _round(_table(spark, sf).drop("position"), 4)


def fidelity(spark, sf):
    return c.fidelity_score(_table(spark, sf))


def fidelity_single_target(spark, sf):
    return c.fidelity_score(_table(spark, sf, legacy_target_entries=False))


def quality_variables(spark, sf):
    return _round(c.quality_variables(_table(spark, sf)), 4)


def _halves(spark, sf):
    """Shopping events against all others."""
    events = table(spark, sf, "events").select("event_type", "value")
    shopping = F.col("event_type").isin("purchase", "signup")
    return events.where(shopping), events.where(~shopping)


def histogram(spark, sf):
    a, b = _halves(spark, sf)
    return _round(c.histograms(a, b, ["value"]), 9)


def statistics(spark, sf):
    return rank_statistics(*_halves(spark, sf), "value").select(
        "size1", "size2", F.round("ks_statistic", 9).alias("ks_statistic"), "u_statistic", "tie_sum"
    )


def tests(spark, sf):
    return two_sample_tests(*_halves(spark, sf), "value").select("test", F.round("statistic", 6).alias("statistic"))


def p_values(spark, sf):
    """P-values and verdicts: events that buy against the others, and line quantities of two flags that hardly differ."""
    lines = table(spark, sf, "lineitem")
    both = {"events": (*_halves(spark, sf), "value"), "lines": (lines.where("l_returnflag = 'A'"), lines.where("l_returnflag = 'R'"), "l_quantity")}
    found = [two_sample_tests(*args).select(F.lit(name).alias("data"), "test", F.round("p_value", 6).alias("p_value"), "significant") for name, args in both.items()]
    return found[0].unionAll(found[1])


def target_bars(spark, sf):
    return _round(c.category_bars(c.target_frequencies(*_both(spark, sf), "l_linenumber")))


QUERIES = {
    "drift_numeric": drift_numeric,
    "drift_categorical": drift_categorical,
    "category_frequencies": frequencies,
    "align_frequencies": align,
    "drift_one_hot": drift_one_hot,
    "drift_target": drift_target,
    "comparison_table": comparison_table,
    "fidelity_score": fidelity,
    "fidelity_score_single_target": fidelity_single_target,
    "quality_report": lambda spark, sf: c.quality_summary(_table(spark, sf)),
    "quality_variables": quality_variables,
    "histogram_compare": histogram,
    "two_sample_statistics": statistics,
    "two_sample_tests": tests,
    "two_sample_p_values": p_values,
    "class_bars": lambda spark, sf: c.class_bars(table(spark, sf, "labels"), "toxic"),
    "category_bars": lambda spark, sf: _round(c.category_bars(c.category_frequencies(*_both(spark, sf), CATEGORICAL))),
    "target_bars": target_bars,
    "generated_statistics": lambda spark, sf: _round(
        c.generated_statistics(*[d.select(*NUMERIC, "l_returnflag") for d in _both(spark, sf)]), 4
    ),
}

# --- SQL -------------------------------------------------------------------


def _moments(name: str) -> str:
    return f"""
      select '{name}' as variable, (select avg({name}) from re) as real_mean, (select stddev_samp({name}) from re) as real_std,
             (select avg({name}) from sy) as synthetic_mean, (select stddev_samp({name}) from sy) as synthetic_std"""


def _freq(column: str, text: str | None = None) -> str:
    value = text or column
    return f"""
      select '{column}' as variable, coalesce(a.k, b.k) as category, coalesce(a.f, 0) as real_freq, coalesce(b.f, 0) as synthetic_freq,
             a.k is not null as in_real
      from (select {value} as k, count(*) / (select count(*) from re) as f from re group by 1) a
      full join (select {value} as k, count(*) / (select count(*) from sy) as f from sy group by 1) b on a.k = b.k"""


_DRIFT = f"""{REAL},
moments as ({' union all '.join(_moments(n) for n in NUMERIC)}),
drift as (
  select variable, real_mean, real_std, synthetic_mean, synthetic_std, abs(synthetic_mean - real_mean) / (abs(real_mean) + 1e-8) as rel_mean_diff,
         abs(synthetic_std - real_std) / real_std as std_rel_diff
  from moments)"""
_FREQUENCIES = f"freq as ({' union all '.join(_freq(x) for x in CATEGORICAL)})"
_TARGET = f"freq as ({_freq('l_linenumber', 'cast(l_linenumber as varchar)')})"
_CAT = """
  select variable, max(abs(real_freq - synthetic_freq)) as max_difference,
         max(case when in_real then abs(real_freq - synthetic_freq) end) as max_real_difference,
         count(*) filter (where abs(real_freq - synthetic_freq) > 0.2) as high_drift_categories, count(*) as total_categories,
         count(*) filter (where abs(real_freq - synthetic_freq) > 0.2) / count(*) as high_drift_ratio,
         max(abs(real_freq - synthetic_freq)) > 0.2 as high_drift
  from freq group by 1"""
_CAT_ROUNDED = f"""
  select variable, round(max_difference, 6) as max_difference, round(max_real_difference, 6) as max_real_difference, high_drift_categories,
         total_categories, round(high_drift_ratio, 6) as high_drift_ratio, high_drift from ({_CAT})"""
_ENTRIES = f"""{_DRIFT}, {_FREQUENCIES}, cat as ({_CAT}),
entries as (
  select variable, 'numeric' as type, real_mean, synthetic_mean, real_std, synthetic_std, rel_mean_diff, std_rel_diff,
         cast(null as bigint) as total_categories, cast(null as double) as max_difference,
         rel_mean_diff > 0.3 or std_rel_diff > 0.3 as high_drift, rel_mean_diff > 0.3 as failed
  from drift
  union all
  select variable, 'categorical', null, null, null, null, null, null, total_categories, max_difference, high_drift, max_real_difference > 0.2 from cat
  union all
  select unnest(['real_freq', 'synthetic_freq']), 'target_frequencies', null, null, null, null, null, null, null, null, false, false
)"""


def _score(source: str, extra: str, level: str) -> str:
    return f"""
    select total_variables, high_drift_variables, {extra} round(s, 2) as fidelity,
           case when s >= 90 then 'excellent' when s >= 80 then 'very_good' when s >= 70 then 'good' when s >= 60 then 'acceptable'
                else 'needs_work' end as {level}
    from (select count(*) as total_variables, count(*) filter (where failed) as high_drift_variables,
                 count(*) filter (where type = 'numeric') as total_numeric, count(*) filter (where type = 'categorical') as total_categorical,
                 (count(*) - count(*) filter (where failed)) / count(*) * 100 as s from {source})"""


_BARS = """select variable, category, side, round(case side when 'real' then real_freq else synthetic_freq end, 6) as proportion
  from freq cross join (select unnest(['real', 'synthetic']) as side)"""
_EVENTS = """
ev as (select value as v, case when event_type in ('purchase', 'signup') then 1 else 0 end as a from events),
cnt as (select v, sum(a) as n1, count(*) - sum(a) as n2 from ev where v is not null group by v),
run as (select *, sum(n1) over (order by v) as c1, sum(n2) over (order by v) as c2, sum(n1) over () as s1, sum(n2) over () as s2 from cnt),
st as (
  select max(s1) as s1, max(s2) as s2, max(abs(c1 / s1 - c2 / s2)) as ks,
         sum(n1 * (c1 - n1 + c2 - n2 + (n1 + n2 + 1) / 2)) as r1, sum(power(n1 + n2, 3) - (n1 + n2)) as ties
  from run)"""

# the error function by its power series, which is exact to 1e-8 up to 4; Kolmogorov's distribution by its alternating series
_ERF = "(2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda i: power(-1, i) * power({0}, 2 * i + 1) / gamma(i + 1) / (2 * i + 1))))"
_KOLMOGOROV = "2 * list_sum(list_transform(range(1, 101), lambda i: power(-1, i - 1) * exp(-2 * i * i * x * x)))"
_P_VALUES = f"""
ev as (
  select 'events' as data, value as v, case when event_type in ('purchase', 'signup') then 1 else 0 end as a from events
  union all select 'lines', l_quantity, case when l_returnflag = 'A' then 1 else 0 end from lineitem where l_returnflag in ('A', 'R')),
cnt as (select data, v, sum(a) as n1, count(*) - sum(a) as n2 from ev where v is not null group by data, v),
run as (
  select *, sum(n1) over (partition by data order by v) as c1, sum(n2) over (partition by data order by v) as c2,
         sum(n1) over (partition by data) as s1, sum(n2) over (partition by data) as s2 from cnt),
st as (
  select data, max(s1)::double as s1, max(s2)::double as s2, max(abs(c1 / s1 - c2 / s2)) as ks,
         sum(n1 * (c1 - n1 + c2 - n2 + (n1 + n2 + 1) / 2)) as r1, sum(power(n1 + n2, 3) - (n1 + n2)) as ties
  from run group by data),
z as (
  select *, sqrt(s1 * s2 / (s1 + s2)) * ks as x, r1 - s1 * (s1 + 1) / 2 as u,
         s1 * s2 / 12 * (s1 + s2 + 1 - ties / ((s1 + s2) * (s1 + s2 - 1))) as variance from st),
e as (select *, (greatest(u, s1 * s2 - u) - s1 * s2 / 2 - 0.5) / sqrt(variance) / sqrt(2) as y from z),
p as (
  select data, 'kolmogorov_smirnov' as test, case when x < 0.2 then 1.0::double else least(1, greatest(0, {_KOLMOGOROV})) end as p from e
  union all select data, 'mann_whitney', case when y > 4 then 0.0::double else least(1, 1 - {_ERF.format('y')}) end from e)"""

SQL = {
    "drift_numeric": f"""
        with {_DRIFT}
        select variable, round(real_mean, 4) as real_mean, round(real_std, 4) as real_std, round(synthetic_mean, 4) as synthetic_mean,
               round(synthetic_std, 4) as synthetic_std, round(rel_mean_diff, 4) as rel_mean_diff, round(std_rel_diff, 4) as std_rel_diff,
               rel_mean_diff > 0.3 or std_rel_diff > 0.3 as high_drift
        from drift""",
    "drift_categorical": f"with {REAL}, {_FREQUENCIES} {_CAT_ROUNDED}",
    "align_frequencies": f"""
        with {REAL},
        a as (select l_returnflag as category, count(*) / sum(count(*)) over () as f from re where l_returnflag <> 'R' group by 1),
        b as (select l_returnflag as category, count(*) / sum(count(*)) over () as f from sy where l_returnflag <> 'A' group by 1)
        select coalesce(a.category, b.category) as category, round(coalesce(a.f, 0), 6) as "left", round(coalesce(b.f, 0), 6) as "right"
        from a full join b on a.category = b.category""",
    "category_frequencies": f"""
        with {REAL}, {_FREQUENCIES}
        select variable, category, round(real_freq, 6) as real_freq, round(synthetic_freq, 6) as synthetic_freq from freq""",
    "drift_one_hot": f"with {REAL}, freq as ({_freq('l_returnflag')}) {_CAT_ROUNDED}",
    "drift_target": f"with {REAL}, {_TARGET} {_CAT_ROUNDED}",
    "comparison_table": f"""
        with {_ENTRIES}
        select variable, type, round(real_mean, 4) as real_mean, round(synthetic_mean, 4) as synthetic_mean, round(real_std, 4) as real_std,
               round(synthetic_std, 4) as synthetic_std, round(rel_mean_diff, 4) as rel_mean_diff, round(std_rel_diff, 4) as std_rel_diff,
               total_categories, round(max_difference, 4) as max_difference, high_drift, failed
        from entries""",
    "fidelity_score": f"with {_ENTRIES} {_score('entries', '', 'quality_level')}",
    "fidelity_score_single_target": f"""
        with {_ENTRIES}, single as (
          select type, failed from entries where type <> 'target_frequencies'
          union all
          select 'categorical', max(abs(real_freq - synthetic_freq)) > 0.2 from ({_freq('l_linenumber', 'cast(l_linenumber as varchar)')}) where in_real)
        {_score('single', '', 'quality_level')}""",
    "quality_report": f"with {_ENTRIES} {_score('entries', 'total_numeric, total_categorical,', 'overall_quality')}",
    "quality_variables": f"""
        with {_ENTRIES}
        select variable, type, round(rel_mean_diff, 4) as rel_mean_diff, round(std_rel_diff, 4) as std_rel_diff, total_categories as categories_count
        from entries where type <> 'target_frequencies'""",
    "histogram_compare": """
        with ev as (select value as v, event_type in ('purchase', 'signup') as a from events),
        l as (select min(v) as lo, max(v) as hi, (max(v) - min(v)) / 30 as step, count(*) filter (where a) as n1, count(*) filter (where not a) as n2 from ev),
        g as (select *, least(cast(floor((v - lo) / step) as int), 29) as guess from ev cross join l where v is not null),
        b as (select a, case when v < lo + guess * step then guess - 1
                             when guess < 29 and v >= lo + (guess + 1) * step then guess + 1 else guess end as bin from g),
        bins as (select cast(unnest(range(30)) as int) as bin)
        select 'value' as variable, bin, round((lo + bin * step + case when bin = 29 then hi else lo + (bin + 1) * step end) / 2, 9) as center,
               round((select count(*) from b where a and b.bin = bins.bin) / n1, 9) as real,
               round((select count(*) from b where not a and b.bin = bins.bin) / n2, 9) as synthetic
        from bins cross join l""",
    "two_sample_statistics": f"""
        with {_EVENTS}
        select cast(s1 as bigint) as size1, cast(s2 as bigint) as size2, round(ks, 9) as ks_statistic,
               cast(r1 - s1 * (s1 + 1) / 2 as double) as u_statistic, cast(ties as double) as tie_sum from st""",
    "two_sample_tests": f"""
        with {_EVENTS}
        select 'kolmogorov_smirnov' as test, round(ks, 6) as statistic from st
        union all select 'mann_whitney', round(cast(r1 - s1 * (s1 + 1) / 2 as double), 6) from st""",
    "two_sample_p_values": f"with {_P_VALUES} select data, test, round(p, 6) as p_value, p < 0.05 as significant from p",
    "class_bars": "select cast(toxic as varchar) as class, count(*) as rows from labels where toxic is not null group by 1",
    "category_bars": f"with {REAL}, {_FREQUENCIES} {_BARS}",
    "target_bars": f"with {REAL}, {_TARGET} {_BARS}",
    "generated_statistics": f"""
        with {_DRIFT}
        select variable, round(real_mean, 4) as original_mean, round(synthetic_mean, 4) as synthetic_mean, round(real_std, 4) as original_std,
               round(synthetic_std, 4) as synthetic_std, round(abs(real_mean - synthetic_mean), 4) as mean_difference from moments""",
}
