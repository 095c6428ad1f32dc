"""Business-rule engine: rules are rows, each folds one DataFrame into the next."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.cleansing import standardize

Rule = Mapping[str, Any]


@dataclass
class RuleContext:
    """What rules may refer to by name: lookup tables and registered DataFrame functions."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    functions: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)


@dataclass
class RuleOutcome:
    df: DataFrame
    applied: list[str]
    skipped: dict[str, str]


def effective_rules(
    rules: DataFrame,
    source_table: str,
    source_layer: str,
    target_layer: str,
    domain: str,
    as_of: Column,
) -> DataFrame:
    """Active rules of one table hop that are still in effect, in execution order."""
    return rules.filter(
        (F.col("source_table") == source_table)
        & (F.col("source_layer") == source_layer)
        & (F.col("target_layer") == target_layer)
        & (F.col("domain") == domain)
        & F.col("is_active")
        & (F.col("effective_to").isNull() | (F.col("effective_to") >= as_of))
    ).orderBy("execution_order", "rule_name")


def _sql_expr(df, rule, params, ctx):
    return df.withColumn(params.get("target_column", rule["rule_name"]), F.expr(rule["rule_expression"]))


def _filter(df, rule, params, ctx):
    return df.filter(F.expr(rule["rule_expression"]))


def _rename(df, rule, params, ctx):
    return df.withColumnRenamed(params["old_name"], params["new_name"])


def _cast(df, rule, params, ctx):
    # try_cast: a bad value becomes NULL in its own row and never fails the batch at run time
    c = F.col(params["column"])
    strict = rule.get("error_handling") == "fail_batch"
    return df.withColumn(params["column"], c.cast(params["type"]) if strict else c.try_cast(params["type"]))


def _standardize(df, rule, params, ctx):
    return df.withColumn(params["column"], standardize(F.col(params["column"])))


def _default(df, rule, params, ctx):
    return df.withColumn(params["column"], F.coalesce(F.col(params["column"]), F.lit(params["value"])))


def _lookup(df, rule, params, ctx):
    """Left join on the lookup key; Spark broadcasts the lookup only when its size allows."""
    value = params["lookup_value"]
    lookup = ctx.tables[params["lookup_table"]].select(
        F.col(params["lookup_key"]).alias("_lookup_key"), F.col(value).alias(f"_lkp_{value}")
    )
    return df.join(lookup, F.col(params["join_key"]) == F.col("_lookup_key"), "left").drop("_lookup_key")


def _function(df, rule, params, ctx):
    return ctx.functions[params["function"]](df)


def _aggregate(df, rule, params, ctx):
    measures = [F.expr(text).alias(name) for name, text in params["measures"].items()]
    return df.groupBy(*params["group_by"]).agg(*measures)


def _history(df, rule, params, ctx):
    from lodestrata.operators.history import scd2_merge

    return scd2_merge(ctx.tables[params["target"]], df, params["keys"], F.expr(params["as_of"]))


RULE_TYPES: dict[str, Callable[..., DataFrame]] = {
    "sql_expr": _sql_expr,
    "filter": _filter,
    "rename": _rename,
    "cast": _cast,
    "standardize": _standardize,
    "default": _default,
    "lookup": _lookup,
    "python_func": _function,
    "aggregate": _aggregate,
    "scd2": _history,
}


def apply_rules(df: DataFrame, rules: Iterable[Rule], ctx: RuleContext | None = None) -> RuleOutcome:
    """Apply rules in order under their error policy.

    Spark is lazy, so every step is analysed at once (``schema`` forces it): a rule that
    names a missing column fails here and not in the final action. ``fail_batch`` re-raises,
    ``default_value`` sets the target column to its default, anything else skips the rule.
    """
    ctx = ctx or RuleContext()
    applied: list[str] = []
    skipped: dict[str, str] = {}
    for row in rules:
        rule = row.asDict() if hasattr(row, "asDict") else dict(row)
        params = json.loads(rule.get("rule_parameters") or "{}")
        try:
            step = RULE_TYPES[rule["rule_type"]](df, rule, params, ctx)
            step.schema  # noqa: B018 - forces analysis
        except (AnalysisException, ParseException, KeyError) as problem:
            policy = rule.get("error_handling")
            if policy == "fail_batch":
                raise
            skipped[rule["rule_name"]] = type(problem).__name__
            if policy == "default_value" and "default" in params:
                target = params.get("target_column") or params.get("column") or rule["rule_name"]
                df = df.withColumn(target, F.lit(params["default"]))
            continue
        df = step
        applied.append(rule["rule_name"])
    return RuleOutcome(df, applied, skipped)


def predicate(
    equals: Mapping[str, Any] | None = None,
    at_least: Mapping[str, Any] | None = None,
    at_most: Mapping[str, Any] | None = None,
) -> Column:
    """Conjunction of the optional conditions that were given (always true when none was)."""
    cond = F.lit(True)
    for name, value in (equals or {}).items():
        if value is not None:
            cond = cond & (F.col(name) == value)
    for name, value in (at_least or {}).items():
        if value is not None:
            cond = cond & (F.col(name) >= value)
    for name, value in (at_most or {}).items():
        if value is not None:
            cond = cond & (F.col(name) <= value)
    return cond


def within(ts: Column, as_of: Column, interval: str) -> Column:
    """``ts`` lies in the last ``interval`` (for example ``'24 HOURS'``) before ``as_of``."""
    return ts >= as_of - F.expr(f"INTERVAL {interval}")
