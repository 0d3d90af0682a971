"""Fit and sample; what SQL can know of the result is its size, its classes and its limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import table
from tabloom import run
from tabloom.operators import comparison as c
from tabloom.operators import synthesis as s

COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CLASS = "l_returnflag"
# short fits: the queries show the operator, not the best model
SETTINGS = dict(epochs=2, batch_size=256, latent_dim=32, hidden=64, learning_rate=0.001)


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(*COLUMNS, CLASS)


def synthesize(spark, sf):
    """As many synthetic lines as there are real ones."""
    df = _lines(spark, sf)
    return s.synthesize(df, df.count(), COLUMNS, CLASS, **SETTINGS)


def synthesize_whole(spark, sf):
    df = _lines(spark, sf).drop(CLASS)
    return s.synthesize(df, df.count(), **SETTINGS)


def sample_bounds(spark, sf):
    """Per class: synthetic rows, and how many leave the limits of their class."""
    limits = _lines(spark, sf).groupBy(CLASS).agg(
        *[f(x).alias(f"{f.__name__}_{x}") for x in COLUMNS for f in (F.min, F.max)]
    )
    outside = " or ".join(f"{x} < min_{x} - 1e-6 or {x} > max_{x} + 1e-6" for x in COLUMNS)
    return (
        synthesize(spark, sf)
        .join(F.broadcast(limits), CLASS)  # one row per class
        .groupBy(CLASS)
        .agg(F.count("*").alias("rows"), F.count_if(F.expr(outside)).alias("outside"))
    )


def _model(spark, sf):
    return s.fit(_lines(spark, sf), COLUMNS, CLASS, **SETTINGS)


def fit_metrics(spark, sf):
    return _model(spark, sf).metrics_table(spark)


def continue_fit(spark, sf):
    """A second fit on top of the first one: rows seen and steps done per class."""
    model = _model(spark, sf)
    new, out = s.continue_fit(_lines(spark, sf), model, epochs=1, batch_size=256)
    more = spark.createDataFrame([(k, new.steps[k] > model.steps[k]) for k in new.steps], f"{CLASS} string, trained_on boolean")
    return out.groupBy(CLASS).agg(F.count("*").alias("rows")).join(more, CLASS)


def generated_validation(spark, sf):
    report = c.generated_validation(_lines(spark, sf), synthesize(spark, sf))
    return spark.createDataFrame(
        [
            (
                *report["shape_comparison"]["original"], *report["shape_comparison"]["synthetic"],
                report["column_comparison"]["columns_match"], report["data_types_match"],
                report["missing_values"]["original"], report["missing_values"]["synthetic"],
            )
        ],
        "rows bigint, columns int, synthetic_rows bigint, synthetic_columns int, columns_match boolean, types_match boolean, "
        "missing bigint, synthetic_missing bigint",
    )


def scorecard(spark, sf):
    """The whole way from a raw table to the score of a synthetic one."""
    raw = table(spark, sf, "lineitem")
    settings = {k: v for k, v in SETTINGS.items()}
    result = run(spark, raw, CLASS, n=raw.count(), **settings)
    return result.comparison.table


def synthesize_summary(spark, sf):
    """Per class of the synthetic lines: rows, missing values and values outside of the real limits by column, against the real ones."""
    real, made = _lines(spark, sf), synthesize(spark, sf)
    limits = real.groupBy(CLASS).agg(*[f(x).alias(f"{f.__name__}_{x}") for x in COLUMNS for f in (F.min, F.max)])
    facts = made.join(F.broadcast(limits), CLASS).groupBy(CLASS).agg(  # one row per class
        F.count("*").alias("rows"),
        *[F.count_if(F.col(x).isNull()).alias(f"missing_{x}") for x in COLUMNS],
        *[F.bool_and((F.col(x) >= F.col(f"min_{x}") - 1e-6) & (F.col(x) <= F.col(f"max_{x}") + 1e-6)).alias(f"inside_{x}") for x in COLUMNS],
    )
    return facts


def synthesize_whole_summary(spark, sf):
    df = _lines(spark, sf).drop(CLASS)
    limits = df.agg(*[f(x).alias(f"{f.__name__}_{x}") for x in COLUMNS for f in (F.min, F.max)])
    made = synthesize_whole(spark, sf)
    return made.join(F.broadcast(limits)).agg(  # one row
        F.count("*").alias("rows"), F.count_if(F.expr(" or ".join(f"{x} is null" for x in COLUMNS))).alias("missing"),
        F.bool_and(F.expr(" and ".join(f"{x} between min_{x} - 1e-6 and max_{x} + 1e-6" for x in COLUMNS))).alias("inside"),
    )


def fit_metrics_facts(spark, sf):
    """Epochs in order, rows that each saw, and whether the losses are numbers."""
    return _model(spark, sf).metrics_table(spark).selectExpr("class", "epoch", "rows", "not isnan(loss_g) and not isnan(loss_d) and loss_d > 0 as sound")


def fit_summary_facts(spark, sf):
    """The summary against the metrics it sums up: as many epochs, final losses among them, none smaller than the smallest."""
    metrics = _model(spark, sf).metrics_table(spark)
    told = s.fit_summary(metrics)
    held = (F.col("min_generator_loss") <= F.col("final_generator_loss")) & (F.col("min_discriminator_loss") <= F.col("final_discriminator_loss"))
    ratio = F.abs(F.col("convergence_ratio") * (F.col("final_generator_loss") + 1e-8) - F.col("final_discriminator_loss")) < 1e-9
    seen = metrics.groupBy("class").agg(F.max("rows").alias("rows"))
    return told.join(seen, "class").select("class", "total_epochs", "rows", (held & ratio).alias("consistent"))


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def full_run_real_side(spark, sf):
    """What a full run says of the real side: rows of its tables, and mean and deviation of the training rows."""
    raw = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice", CLASS).dropDuplicates(LINE_KEYS)
    result = run(spark, raw, CLASS, n=raw.count(), keys=LINE_KEYS, **SETTINGS)
    train = result.train.agg(*[F.round(f(x), 4).alias(f"{f.__name__}_{x}") for x in ("l_quantity", "l_extendedprice") for f in (F.avg, F.stddev)])
    sizes = [F.lit(t.count()).cast("bigint").alias(n) for n, t in (("cleaned", result.cleaned), ("train", result.train), ("test", result.test), ("balanced", result.balanced), ("synthetic", result.synthetic))]
    return train.select("*", *sizes)


QUERIES = {
    "synthesize_summary": synthesize_summary,
    "synthesize_whole_summary": synthesize_whole_summary,
    "fit_metrics_facts": fit_metrics_facts,
    "fit_summary_facts": fit_summary_facts,
    "full_run_real_side": full_run_real_side,
    "synthesize": synthesize,
    "synthesize_whole_table": synthesize_whole,
    "sample_bounds": sample_bounds,
    "fit_metrics": fit_metrics,
    "fit_summary": lambda spark, sf: s.fit_summary(_model(spark, sf).metrics_table(spark)),
    "continue_fit": continue_fit,
    "generated_validation": generated_validation,
    "full_run_scorecard": scorecard,
}

_QUOTAS = """
  c as (select l_returnflag, row_number() over (order by l_returnflag) as i, count(*) over () as k from (select distinct l_returnflag from lineitem)),
  n as (select count(*) as n from lineitem),
  q as (select l_returnflag, cast(n // k + case when i = 1 then n - k * (n // k) else 0 end as bigint) as rows from c cross join n)"""

# the cleaner makes numbers of the keys, so they read as 1.0, 2.0, ...
_HASH = "md5('42|' || " + " || '|' || ".join(f"length({k}::double::varchar) || ':' || {k}::double::varchar" for k in LINE_KEYS) + ")"

SQL = {
    "synthesize_summary": f"""with {_QUOTAS}, r as (
          select l_returnflag, {', '.join(f'count(*) - count({x}) as missing_{x}, min({x}) <= max({x}) as inside_{x}' for x in COLUMNS)} from lineitem group by 1)
        select l_returnflag, rows, {', '.join(f'missing_{x}, inside_{x}' for x in COLUMNS)} from q join r using (l_returnflag)""",
    "synthesize_whole_summary": f"""
        select count(*) as rows, count(*) - count({' + '.join(COLUMNS)}) as missing, {' and '.join(f'min({x}) <= max({x})' for x in COLUMNS)} as inside from lineitem""",
    "fit_metrics_facts": f"""
        select l_returnflag as class, cast(e as integer) as epoch, count(*) as rows, count(*) > 0 as sound
        from lineitem cross join range({SETTINGS['epochs']}) t(e) group by 1, 2""",
    "fit_summary_facts": f"""
        select l_returnflag as class, cast({SETTINGS['epochs']} as bigint) as total_epochs, count(*) as rows, count(*) > 0 as consistent from lineitem group by 1""",
    "full_run_real_side": f"""
        with lines as (select distinct on ({', '.join(LINE_KEYS)}) {', '.join(LINE_KEYS)}, l_quantity, l_extendedprice, l_returnflag from lineitem),
        c as (select l_returnflag as k, count(*) as n from lines group by 1),
        t as (select sum(n) as total, ceil(0.2 * sum(n)) as test, sum(n) - ceil(0.2 * sum(n)) as train, count(*) as classes from c),
        f as (select k, n, floor(n * train / total) as base, n * train / total - floor(n * train / total) as frac, train from c cross join t),
        q as (select k, base + case when row_number() over (order by frac desc, k) <= train - sum(base) over () then 1 else 0 end as keep, n from f),
        ranked as (select lines.*, row_number() over (partition by l_returnflag order by {_HASH} desc) as place from lines),
        train as (select ranked.* from ranked join q on l_returnflag = k where place <= keep)
        select {', '.join(f'round(avg({x}), 4) as avg_{x}, round(stddev({x}), 4) as stddev_{x}' for x in ('l_quantity', 'l_extendedprice'))},
               cast((select total from t) as bigint) as cleaned, count(*) as train, cast((select test from t) as bigint) as test,
               cast((select min(keep) * count(*) from q) as bigint) as balanced, cast((select total from t) as bigint) as synthetic
        from train""",
    "sample_bounds": f"with {_QUOTAS} select l_returnflag, rows, cast(0 as bigint) as outside from q",
    "continue_fit": f"with {_QUOTAS} select l_returnflag, rows, true as trained_on from q",
    "generated_validation": """
        select count(*) as rows, 5 as columns, count(*) as synthetic_rows, 5 as synthetic_columns, true as columns_match, true as types_match,
               cast(0 as bigint) as missing, cast(0 as bigint) as synthetic_missing from lineitem""",
}
