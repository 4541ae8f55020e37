"""Rules over names: identifiers, personal data, tables, words of fields, roles of columns."""

import pytest
from pyspark.sql import types as T

from loomlake.functions import names as N
from loomlake.operators import charts, matching
from loomlake.operators.views import plan_view


@pytest.mark.parametrize(("raw", "want"), [
    ("a.b", "a_b"), ("a b", "a_b"), ("field(name)", "field_name"), ("field=value", "field_value"), ("line\nbreak", "line_break"), ("123abc", "col_123abc"),
    ("", "unnamed_field"), ("_id", "_id"), ("__source_id", "__source_id"), ("é", "é"), ("الاسم", "الاسم"), ("a$b", "a$b"), ("a b_", "a_b_"), ("__a b", "_a_b"), ("_", "_"), ("a__b", "a__b"), (" a. b ", "a_b"), (".", "unnamed_field"), ("-1x", "col_1x"),
])
def test_sanitized_columns(raw, want):
    assert N.sanitize_column(raw)[0] == want
    assert (N.sanitize_column(raw)[1] == []) == (raw == want)


def test_reasons_of_new_names():
    assert N.sanitize_column("a. b")[1] == ["invalid_characters"] and N.sanitize_column("a._b")[1] == ["invalid_characters", "collapsed_underscores"]
    assert N.sanitize_column(".1")[1] == ["invalid_characters", "trimmed_underscores", "starts_with_number"] and N.sanitize_column(None) == ("unnamed_field", ["empty_name"])


def test_unique_names():
    assert list(N.sanitize_columns(["a.b", "a b", "a_b", "A_B"]).values()) == ["a_b", "a_b_2", "a_b_3", "A_B_4"]
    assert N.unique_names(["x", "X"], ["x_2"]) == ["x", "X_3"]


def test_identifiers():
    assert [N.safe_identifier(x) for x in ("My Table!", "9lives", "", "a" * 200)] == ["my_table", "t_9lives", "unnamed", "a" * 128]
    assert N.clean_table_name("shop", "Order Items") == "shop__order_items_clean" and N.child_table_name("shop__orders_clean", "items.tags") == "shop__orders_items_tags_clean"
    assert N.view_name("shop__orders_clean") == "shop__orders_analytics" and N.slugify("A b/C") == "a-b-c" and N.humanize("orderItems_count") == "Order Items Count"
    assert N.quote("a`b") == "`a``b`"


def test_personal_data():
    yes = ("email", "customerEmail", "mobile", "full_name", "nation_name", "passportNo", "apiToken", "dateOfBirth")
    assert all(map(N.is_pii_column, yes))
    assert not any(map(N.is_pii_column, ("email_hash", "product_name", "source_name", "amount", "country")))
    assert N.pii_type("contact.mobile") == "phone" and N.pii_confidence("email") == 0.98 and N.pii_confidence("billing_email") == 0.9 and N.pii_confidence("color") == 0.7
    assert [N.pii_protection("email", v) for v in (None, ["email"], ["email_hash"], ["x"])] == ["missing_safe_view", "exposed", "hashed", "excluded"]
    assert N.is_unsafe_json("data_json") and N.is_unsafe_json("raw_payload_x") and not N.is_unsafe_json("data_json", ["data_json"])


def test_tables():
    assert N.classify_table("userpreference", "", []) == "dynamic_config_like" and N.classify_table("events", "", ["email"]) == "pii_sensitive"
    assert N.classify_table_for_audit("events", "", ["email"]) == "log_like" and N.classify_table("orders", "", []) == "transactional"
    assert N.bi_suitability("transactional") == "bi_ready" and N.bi_suitability("analytics_ready", 60) == "needs_custom_transform"


def test_view_plans():
    plan = plan_view(["id", "email", "email_hash", "extra_raw_json", "amount"])
    assert plan.passed == {"id": "id", "email_hash": "email_hash", "amount": "amount"} and plan.hashed == {"email_hash_2": "email"} and plan.blocked == ["extra_raw_json"]


def test_words_of_names():
    assert matching.words_of("Submitted By Email") == ["submitted", "email"] and matching.words_of("approvedCompanyName") == ["approved", "company", "name"]
    assert matching.words_of("app_nos") == ["application", "nos"] and matching.words_of("companies_status") == ["company", "status"]
    assert matching.core_of(["company", "name"]) == ["company"] and matching.core_of(["order", "number"]) == ["order"] and matching.core_of(["number"]) == ["number"]
    assert matching.expected_type("Created Date") == "temporal" and matching.expected_type("waiting queue") == "duration" and matching.expected_type("Colour") is None


def test_roles_of_columns():
    f = lambda n, t: charts.roles(T.StructField(n, t))
    assert f("created_at", T.StringType()) == {"temporal"} and f("order_status", T.StringType()) == {"enum"} and f("total_amount", T.DoubleType()) == {"measure"}
    assert f("status_id", T.StringType()) == set() and f("countid", T.LongType()) == set() and f("x", T.DateType()) == {"temporal"} and f("status_hash", T.StringType()) == set()


def test_failures():
    assert N.failure_kind("SparkContext was shut down")[0] == "jvm_crash" and N.failure_kind("AnalysisException: cannot resolve")[0] == "analysis_error" and N.failure_kind("?")[0] == "unknown"
