"""Tables that drive the operators, with the columns that these read, and one event payload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CONTROL_TABLES = {
    # one row for each table or folder to be loaded; read by operators.ingest
    "ingestion_rules": """
        rule_id string NOT NULL, source_id string NOT NULL, source_table_or_path string, source_query string,
        file_format string, target_table string, ingestion_mode string, incremental_column string,
        incremental_value string, dedup_columns string, partition_columns string, schema_enforcement string,
        domain string, priority int, is_active boolean""",
    # where a rule's rows come from
    "source_systems": "source_id string NOT NULL, source_type string, environment string, is_active boolean",
    # source column or expression of each target column
    "schema_mapping": """
        rule_id string NOT NULL, column_order int, source_column string, target_column string,
        target_data_type string, transformation_expr string""",
    # settings by environment
    "environment_config": "config_key string NOT NULL, environment string NOT NULL, config_value string",
    # read by operators.monitoring.evaluate_alerts; "table" and "condition" are those of the rule
    "alert_rules": """
        alert_id string NOT NULL, severity string, table string, condition string, ts string, entity string,
        cooldown_minutes int, is_active boolean""",
    # read by operators.security
    "sensitive_columns": """
        table_name string NOT NULL, column_name string NOT NULL, layer string, masking_strategy string,
        masking_parameters string, unmasked_roles string, is_active boolean""",
    # read by operators.quality
    "quality_rules": """
        rule_name string NOT NULL, table_name string, column_name string, check_expression string,
        threshold_value double, severity string, is_active boolean""",
    # read by operators.history
    "retention_policies": "table_name string NOT NULL, retention_days int, action string, is_active boolean",
}

#: A payment as it comes in an event stream.
PAYMENT_EVENT = """
    transaction_id string NOT NULL, event_type string NOT NULL, policy_id string, amount double NOT NULL,
    currency string NOT NULL, payment_method string, event_timestamp timestamp NOT NULL"""


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A typed empty control table."""
    return spark.createDataFrame([], CONTROL_TABLES[name])


def control_rows(spark: SparkSession, name: str, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Rows of a control table; absent columns are NULL."""
    fields = empty_table(spark, name).schema.fields
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], CONTROL_TABLES[name])
