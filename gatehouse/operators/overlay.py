"""Settings overlay -- an override wins whenever it is present."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlay_settings(df: DataFrame, overrides: DataFrame, key: str, defaults: Mapping[str, str] | DataFrame,
                     override_key: str = "key") -> DataFrame:
    """Add each setting of ``defaults``: the override for ``df[key]`` where there is one, else the default.

    ``overrides`` has ``override_key`` and a column for each setting, null where the
    setting has no override; ``defaults`` maps settings to values, or is a table of one
    row (a settings row; a missing row gives null defaults). One join serves all settings. An empty
    override is kept: only an *absent* one falls back, so this is a left join +
    coalesce, never ``nullif(value, '')``. ``<setting>_source`` says ``override`` or
    ``default``. A repeated key (a data error) is collapsed to its largest value, setting by setting,
    so ``df`` keeps exactly its rows; a null key has no override. Columns of these names in
    ``df`` are replaced. The join strategy is left to the planner: AQE broadcasts the
    overrides only when their measured size is under the threshold and keeps
    a sort-merge join otherwise.
    """
    if isinstance(defaults, DataFrame):
        row = defaults.limit(1).collect()
        defaults = {c: row[0][c] if row else None for c in defaults.columns}
    names = list(defaults)
    held = (overrides.groupBy(F.col(override_key).alias("_ov_key"))
            .agg(*(F.max(c).alias(f"_ov_{c}") for c in names)))
    made = {*names, *(f"{c}_source" for c in names)}

    def settings(c: str) -> list[Column]:
        value = F.col(f"`_ov_{c}`")
        return [F.coalesce(value, F.lit(defaults[c])).alias(c),
                F.when(value.isNull(), "default").otherwise("override").alias(f"{c}_source")]

    joined = df.join(held, df[key] == held["_ov_key"], "left")
    kept = [df[c] for c in df.columns if c not in made]
    return joined.select(*kept, *(x for c in names for x in settings(c)))


def overlay(df: DataFrame, overrides: DataFrame, key: str, default: str,
            out: str = "value") -> DataFrame:
    """One setting of :func:`overlay_settings`, from ``overrides`` (key, value)."""
    return overlay_settings(df, overrides.select("key", F.col("value").alias(out)), key, {out: default})
