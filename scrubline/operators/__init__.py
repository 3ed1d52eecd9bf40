"""DataFrame operators: audits, statistics, imputation, quality, words."""

from scrubline.operators.audit import (
    impute_report,
    missing_counts,
    missing_long,
    missing_percentages,
    missing_report,
    missing_wide,
    non_numeric_counts,
    row_missing_profile,
    table_shape,
)
from scrubline.operators.heavy import bounded_modes, bounded_modes_table
from scrubline.operators.impute import (
    Fill,
    ImputeModel,
    fit_bounded_modes,
    fit_mean,
    fit_median,
    fit_median_and_modes,
    fit_modes,
    fit_modes_where_missing,
)
from scrubline.operators.inference import inferred_schema, inferred_types, typed
from scrubline.operators.means import exact_mean, exact_sums
from scrubline.operators.observed import observed_snapshot, snapshot_with_audit
from scrubline.operators.preview import preview
from scrubline.operators.quality import (
    Domain,
    complete_rows,
    domain_violations,
    incomplete_rows,
    null_out_of_domain,
    valid_scores,
)
from scrubline.operators.quantiles import exact_quantiles, quantile_table
from scrubline.operators.stats import (
    approximate_quantile,
    column_mean,
    column_modes,
    exact_quantile,
    value_distribution,
)
from scrubline.operators.words import (
    length_distribution,
    length_histogram,
    top_words,
    with_label,
    word_counts,
)

__all__ = [
    "Domain",
    "Fill",
    "ImputeModel",
    "approximate_quantile",
    "bounded_modes",
    "bounded_modes_table",
    "column_mean",
    "column_modes",
    "complete_rows",
    "domain_violations",
    "exact_mean",
    "exact_quantile",
    "exact_quantiles",
    "exact_sums",
    "fit_bounded_modes",
    "fit_mean",
    "fit_median",
    "fit_median_and_modes",
    "fit_modes",
    "fit_modes_where_missing",
    "impute_report",
    "incomplete_rows",
    "inferred_schema",
    "inferred_types",
    "length_distribution",
    "length_histogram",
    "missing_counts",
    "missing_long",
    "missing_percentages",
    "missing_report",
    "missing_wide",
    "non_numeric_counts",
    "null_out_of_domain",
    "observed_snapshot",
    "preview",
    "quantile_table",
    "row_missing_profile",
    "snapshot_with_audit",
    "table_shape",
    "top_words",
    "typed",
    "valid_scores",
    "value_distribution",
    "with_label",
    "word_counts",
]
