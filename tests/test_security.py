import pytest
from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.functions import masks
from lodestrata.operators import access, security
from lodestrata.plans.registry import at


def one(spark, fn, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "fn, value, want",
    [
        (masks.show_ssn, "123-45-6789", "XXX-XX-6789"),
        (masks.show_ssn, "987-65-4321", "XXX-XX-4321"),
        (masks.show_card, "1234-5678-9012-3456", "XXXX-XXXX-XXXX-3456"),
        (masks.show_card, "12", "XXXX-XXXX-XXXX-XXXX"),
        (masks.show_phone, "555-123-4567", "XXX-XXX-4567"),
        (masks.show_email, "john.doe@email.com", "j***@email.com"),
        (masks.show_email, "j@email.com", "***@email.com"),
        (masks.show_email, "nobody", None),
        (masks.show_address, "123 Main St, Boston, MA", "*****, Boston, MA"),
        (masks.show_address, "somewhere", "*****"),
    ],
)
def test_display_masks(spark, fn, value, want):
    assert one(spark, fn, value) == want
    assert one(spark, fn, None) is None


@pytest.mark.parametrize("name", sorted(masks.STRATEGIES))
def test_null_stays_null(spark, name):
    kind = "date" if name == "date_shift" else "string"
    got = one(spark, lambda c: masks.STRATEGIES[name](c, {"salt": "s", "key": "k"}), None, kind)
    assert got == (masks.REDACTED if name == "full_redact" else None)


def test_partial_mask_of_short_values(spark):
    assert one(spark, lambda c: masks.partial_mask(c, {}), "123") == "123"
    assert one(spark, lambda c: masks.partial_mask(c, {"visible_last": 2, "mask_char": "*"}), "12345") == "***45"


def test_date_shift_keeps_intervals_of_an_entity(spark):
    df = spark.sql("SELECT 'e' AS k, DATE'2024-01-01' AS d UNION ALL SELECT 'e', DATE'2024-03-01'")
    out = df.select(masks.date_shift(F.col("d"), {"entity_column": "k"}).alias("d")).agg(F.datediff(F.max("d"), F.min("d"))).first()[0]
    assert out == 60


def test_format_keeping(spark):
    got = one(spark, lambda c: masks.format_keeping(c, {"key": "k"}), "Ab-12 x")
    assert got != "Ab-12 x" and got[2] == "-" and got[5] == " " and got[0].isupper() and got[3:5].isdigit()


def test_roles(spark):
    df = spark.createDataFrame([("1", "a@b.example")], "id string, email string")
    reg = [{"table_name": "t", "column_name": "email", "masking_strategy": "email_mask", "unmasked_roles": '["marketing"]'}]
    assert security.mask_for_role(df, reg, "t", ["marketing"]).first().email == "a@b.example"
    assert security.mask_for_role(df, reg, "t", []).first().email == "a@***@b.example"
    odd = [{**reg[0], "masking_strategy": "unheard_of"}]
    assert security.mask_for_role(df, odd, "t", []).first().email == masks.MASKED


def test_scan_by_name_and_value(spark):
    df = spark.createDataFrame([("123-45-6789", "x", "y")] * 3, "a string, birth_date string, note string")
    got = {r.column_name: (r.data_element_type, r.detection_method, r.sensitivity_class) for r in security.scan_values(df, "t").collect()}
    assert got == {"a": ("ssn", "regex_pattern", "PII_HIGH"), "birth_date": ("dob", "column_name_pattern", "PII_MEDIUM")}


def test_registry_masks(spark):
    df = spark.createDataFrame([("4111222233334444", "123", "12/30")], "card_number string, card_cvv string, card_expiry string")
    rows = [("card_number", "partial_mask"), ("card_cvv", "null_out"), ("card_expiry", "full_redact")]
    registry = schemas.control_rows(spark, "sensitive_columns", [
        {"table_name": "fact_payment", "column_name": c, "layer": "gold", "masking_strategy": s, "masking_parameters": "{}", "unmasked_roles": "[]", "is_active": True} for c, s in rows
    ])
    row = security.mask_table(df, [r.asDict() for r in registry.collect()], "fact_payment", "gold").first()
    assert tuple(row) == ("XXXXXXXXXXXX4444", None, masks.REDACTED)


def test_tracked_read(spark):
    df = spark.createDataFrame([(1, "x")], "id int, email string")
    _, log = access.tracked_read(spark, "t", df, "u1", at("2024-01-01"))
    row = log.first()
    assert row.pii_accessed and row.sensitive_columns == ["email"] and row.operation == "read"
    assert access.revocation_row(spark, "u1", "left", at("2024-01-01")).first().operation == "revoke"


def test_severity_filter_covers_every_log(spark):
    data = spark.createDataFrame([(1, 7, "t", "read", True, "x")], "event_id int, user_id int, table_name string, operation string, flagged boolean, flag_reason string").withColumn("ts", at("2024-01-01"))
    compute = data.withColumnRenamed("table_name", "resource_name")
    control = compute.withColumn("severity", F.lit("high"))
    assert access.flagged_accesses(compute, data, control).count() == 3
    assert access.flagged_accesses(compute, data, control, "high").count() == 1


def test_control_schemas(spark):
    for name in schemas.CONTROL_TABLES:
        assert schemas.empty_table(spark, name).count() == 0
    assert schemas.control_rows(spark, "environment_config", [{"config_key": "k", "environment": "prod", "config_value": "v"}]).count() == 1
