"""The data model's own rules applied to its tables: keys, references, required columns, domains, defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.integrity import duplicate_keys, in_domain, orphans, with_defaults
from tidewright.schemas import DEFAULTS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, VIDEO_FORMATS

DOMAINS = {"registry": {"video_format": VIDEO_FORMATS}, "snippets": {"video_format": VIDEO_FORMATS}}


def audit_model(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per rule that concerns the given tables: ``table_name``, ``rule``, ``columns``, ``violations``.

    Violations are rows, for a primary key the key values that occur more than once, for a default the rows it would
    fill. A reference is checked if its parent is given; a null reference breaks none. Each table is read once for
    all its rules on single rows; keys and references take one aggregation or join on the key.
    """
    parts = []
    for name, df in tables.items():
        row_rules = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL.get(name, [])]
        row_rules += [("domain", c, ~in_domain(F.col(c), labels)) for c, labels in DOMAINS.get(name, {}).items()]
        row_rules += [("default", c, F.col(c).isNull()) for c in DEFAULTS.get(name, {})]
        if row_rules:
            cells = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("columns"), F.count_if(v).alias("violations")) for r, c, v in row_rules]
            parts.append(df.agg(F.array(*cells).alias("cells")).select(F.lit(name).alias("table_name"), F.inline("cells")))
        broken = {("primary_key", ",".join(PRIMARY_KEYS[name])): duplicate_keys(df, PRIMARY_KEYS[name])}
        parent, key = FOREIGN_KEYS.get(name, (None, None))
        if parent in tables:
            broken["foreign_key", key] = orphans(df.where(F.col(key).isNotNull()), tables[parent], [key])
        for (rule, columns), rows in broken.items():
            parts.append(
                rows.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.lit(columns).alias("columns"), "violations"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def with_model_defaults(name: str, df: DataFrame) -> DataFrame:
    """The table with the model's defaults in place of nulls."""
    return with_defaults(df, DEFAULTS.get(name, {}))
