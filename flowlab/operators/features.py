"""From cleaned flows to the table a classifier is trained on.

Order matters: NaN becomes NULL before capping (NaN is larger than any bound, so it would turn
into the upper one), and NULL becomes 0.0 after it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from flowlab.functions.derived import LOGS, OVER_TOTALS, RATIOS, TOTALS, Derived
from flowlab.functions.values import attack_flag, clamp, not_nan
from flowlab.operators.quantiles import approximate_quantiles, exact_quantiles

# The bounds that outliers are capped at, and the columns of the closing check.
LOWER, UPPER = 0.01, 0.99
CHECKED = (
    "duration",
    "bytes_rate",
    "packets_rate",
    "total_packets",
    "total_payload_bytes",
    "avg_payload_per_packet",
    "fwd_bwd_packet_ratio",
    "log_duration",
    "log_bytes_rate",
    "log_packets_rate",
)

Caps = dict[str, tuple[float, float]]


def binary_target(df: DataFrame, label: str = "label") -> DataFrame:
    """The class name moves to ``label_original``; ``label`` becomes 0.0 (benign) or 1.0."""
    return df.withColumnRenamed(label, "label_original").withColumn("label", attack_flag("label_original"))


def add_derived(df: DataFrame, *groups: Iterable[Derived]) -> DataFrame:
    """Adds the features whose inputs exist, all of a group in one projection."""
    for group in groups or ((*TOTALS, *RATIOS, *LOGS), OVER_TOTALS):
        present = [d for d in group if set(d.inputs) <= set(df.columns)]
        df = df.withColumns({d.name: d.rule(*map(F.col, d.inputs)) for d in present}) if present else df
    return df


def numeric_columns(df: DataFrame, ignore: Iterable[str] = ("label", "label_original")) -> list[str]:
    """Feature columns by type. Add columns that may give the class away to ``ignore``."""
    skip = set(ignore)
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]
    if not found:
        raise ValueError("the table has no numeric feature column")
    return found


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: not_nan(F.col(c).cast("double")) for c in columns})


def fit_caps(
    df: DataFrame,
    columns: list[str],
    lower: float = LOWER,
    upper: float = UPPER,
    rel_error: float = 0.001,
    exact: bool = False,
) -> Caps:
    """{column: (low, high)}; empty and constant columns are left out.

    Fit on all rows, or on the training rows alone to keep the test set unseen. The bounds are
    two numbers per column and become literals of the next plan.
    """
    if exact:
        rows = exact_quantiles(df, columns, [lower, upper]).collect()
        at = {(r["column"], r["probability"]): r["value"] for r in rows}
        bounds = {c: (at[c, lower], at[c, upper]) for c in columns if (c, lower) in at}
    else:
        found = approximate_quantiles(df, columns, [lower, upper], rel_error)
        bounds = {c: (v[0], v[1]) for c, v in found.items() if len(v) == 2}
    return {c: b for c, b in bounds.items() if b[0] < b[1]}


def apply_caps(df: DataFrame, caps: Caps) -> DataFrame:
    return df.withColumns({c: clamp(F.col(c), *b) for c, b in caps.items()}) if caps else df


def fill_missing(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=columns)


def engineered(df: DataFrame, label: str = "label") -> DataFrame:
    """Binary target and derived features; numeric columns as doubles without NaN."""
    df = add_derived(binary_target(df, label))
    return nan_to_null(df, numeric_columns(df))


def feature_table(df: DataFrame, caps: Caps | None = None, exact: bool = False) -> DataFrame:
    """Cleaned flows to the full feature table: engineered, capped, without missing values."""
    df = engineered(df)
    columns = numeric_columns(df)
    caps = fit_caps(df, columns, exact=exact) if caps is None else caps
    return fill_missing(apply_caps(df, caps), columns)


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value: they carry nothing into a model."""
    row = df.agg(
        *(F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)),
        *(F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)),
    ).first()
    return [c for i, c in enumerate(columns) if row[f"lo_{i}"] == row[f"hi_{i}"]]


def assemble(df: DataFrame, columns: list[str] | None = None, key: str = "flow_id") -> DataFrame:
    """``features`` vector, ``label``, ``label_original`` and, where it exists, the row key."""
    columns = columns or numeric_columns(df)
    vectors = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
    kept = [c for c in (key, "features", "label", "label_original") if c == "features" or c in df.columns]
    return vectors.transform(df).select(*kept)
