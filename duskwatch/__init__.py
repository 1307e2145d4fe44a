"""Detection, investigation and response over security logs, as lazy Spark plans."""

from duskwatch.operators.filters import (
    filter_by_relative_time,
    filter_by_time,
    filter_column_by_category,
    filter_column_by_custom_function,
    filter_column_by_date_range,
    filter_column_by_multiple_conditions,
    filter_column_by_string_pattern,
    filter_column_by_value,
    filter_columns_by_categories,
    filter_columns_by_custom_function,
    filter_columns_by_date_ranges,
    filter_columns_by_multiple_conditions,
    filter_columns_by_string_pattern,
    filter_columns_by_values,
    filter_rows_with_all_null,
    filter_rows_with_any_null,
)
from duskwatch.operators.relational import (
    aggregate_data,
    join_tables,
    select_columns,
    sort_by_column,
    sort_by_columns,
)
from duskwatch.operators.rules import (
    pattern_based_rule,
    statistical_anomaly_detection,
    statistical_anomaly_detection_group_by,
    statistically_significant_window_by_std,
    threshold_based_rule,
    threshold_based_rule_multiple_group_by,
    trending_based_rule,
)
from duskwatch.sources.tables import get_table

__all__ = [
    "aggregate_data",
    "filter_by_relative_time",
    "filter_by_time",
    "filter_column_by_category",
    "filter_column_by_custom_function",
    "filter_column_by_date_range",
    "filter_column_by_multiple_conditions",
    "filter_column_by_string_pattern",
    "filter_column_by_value",
    "filter_columns_by_categories",
    "filter_columns_by_custom_function",
    "filter_columns_by_date_ranges",
    "filter_columns_by_multiple_conditions",
    "filter_columns_by_string_pattern",
    "filter_columns_by_values",
    "filter_rows_with_all_null",
    "filter_rows_with_any_null",
    "get_table",
    "join_tables",
    "pattern_based_rule",
    "select_columns",
    "sort_by_column",
    "sort_by_columns",
    "statistical_anomaly_detection",
    "statistical_anomaly_detection_group_by",
    "statistically_significant_window_by_std",
    "threshold_based_rule",
    "threshold_based_rule_multiple_group_by",
    "trending_based_rule",
]
