"""What the SQL gate lets through, and what it doesn't."""

import pytest
from pyspark.sql import functions as F

from loomlake.plans import gate

ALLOWED = {"shop__orders_analytics", "shop__users_analytics", "report_sales_analytics"}

GOOD = [
    "SELECT * FROM shop__orders_analytics",
    "select count(*) from shop__orders_analytics;",
    "SELECT a.x FROM shop__orders_analytics a, shop__users_analytics b WHERE a.k = b.k",
    "WITH t AS (SELECT 1 AS x FROM shop__orders_analytics) SELECT * FROM t",
    "SELECT extract(year FROM ts), 'DROP TABLE x; DELETE' FROM shop__orders_analytics",
    "SELECT * FROM delta.silver.shop__orders_analytics WHERE x IN (SELECT y FROM silver.shop__users_analytics)",
    "SELECT x FROM shop__orders_analytics UNION ALL SELECT y FROM shop__users_analytics ORDER BY 1 LIMIT 5",
    "/* note */ SELECT (SELECT max(y) FROM shop__users_analytics) AS m FROM shop__orders_analytics -- end",
    "TABLE shop__orders_analytics",
    'SELECT "x" FROM "shop__orders_analytics"',
]
BAD = [
    "", "   ", "DROP TABLE shop__orders_analytics", "DELETE FROM shop__orders_analytics", "UPDATE shop__orders_analytics SET x = 1",
    "INSERT INTO t SELECT * FROM shop__orders_analytics", "ALTER VIEW shop__orders_analytics AS SELECT 1", "CREATE TABLE t AS SELECT * FROM shop__orders_analytics",
    "SELECT * FROM shop__orders_clean", "SELECT * FROM shop__orders_analytics, shop__orders_clean", "SELECT * FROM shop__orders_analytics JOIN bronze.shop__orders ON true",
    "SELECT * FROM shop__orders_analytics WHERE x IN (SELECT x FROM shop__orders_clean)", "SELECT (SELECT max(x) FROM shop__orders_clean) FROM shop__orders_analytics",
    "WITH t AS (SELECT * FROM shop__orders_clean) SELECT * FROM t, shop__orders_analytics", "SELECT EXISTS (SELECT 1 FROM shop__orders_clean) FROM shop__orders_analytics",
    "SELECT * FROM parquet.`/etc/data`", "SELECT * FROM shop__orders_analytics, range(5)", "VALUES (1)", "SELECT 1", "SELECT * FROM shop__orders_analytics; SELECT 1",
    "SET spark.sql.ansi.enabled=false", "EXPLAIN SELECT * FROM shop__orders_analytics", "SHOW TABLES",
    "SELECT java_method('java.lang.System', 'exit', 1) FROM shop__orders_analytics", "SELECT x FROM shop__orders_analytics WHERE reflect('a', 'b') = 1",
    "MERGE INTO shop__orders_analytics t USING shop__users_analytics s ON t.x = s.x WHEN MATCHED THEN DELETE", "SELECT " + "x, " * 4000 + "y FROM shop__orders_analytics",
    "SELECT * FROM " + " JOIN ".join(["shop__orders_analytics"] * 7), "SELECT * FROM " + ", ".join(["shop__orders_analytics"] * 7), "SELECT * FROM other.shop__orders_analytics",
]


@pytest.mark.parametrize("sql", GOOD)
def test_allowed(spark, sql):
    assert gate.check_sql(spark, sql, ALLOWED).relations


@pytest.mark.parametrize("sql", BAD)
def test_refused(spark, sql):
    with pytest.raises(gate.Refused):
        gate.check_sql(spark, sql, ALLOWED)


def test_roles(spark):
    assert gate.check_sql(spark, "SELECT * FROM report_sales_analytics", ALLOWED, "bi").relations == ("report_sales_analytics",)
    with pytest.raises(gate.Refused):
        gate.check_sql(spark, "SELECT * FROM shop__orders_clean", {"shop__orders_clean"}, "bi")
    assert gate.check_sql(spark, "SELECT * FROM shop__orders_clean", {"shop__orders_clean"}, "admin")


def test_limits_and_history(spark):
    spark.range(500).createOrReplaceTempView("shop__orders_analytics")
    history = gate.History([])
    assert len(gate.run(spark, "SELECT * FROM (SELECT * FROM shop__orders_analytics LIMIT 400) LIMIT 300", ALLOWED, history)) == 100
    assert gate.gated(spark, 'SELECT "id" FROM shop__orders_analytics WHERE "id" < 3', ALLOWED).count() == 3
    with pytest.raises(gate.Refused):
        gate.run(spark, "SELECT * FROM secret", ALLOWED, history)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        gate.run(spark, "SELECT nothing FROM shop__orders_analytics", ALLOWED, history)
    rows = history.frame(spark).collect()
    assert [r["status"] for r in rows] == ["ok", "blocked", "failed"] and rows[0]["row_count"] == 100
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_long_queries_are_cancelled(spark):
    spark.range(0, 200_000_000_000, 1, 4).createOrReplaceTempView("shop__orders_analytics")
    history = gate.History([])
    with pytest.raises(Exception):  # noqa: B017  a cancelled job
        gate.run(spark, "SELECT sum(id % 7) FROM shop__orders_analytics WHERE id % 3 = 1", ALLOWED, history, seconds=1)
    assert history.rows[-1][3] in ("cancelled", "blocked")


def test_fingerprints():
    assert gate.fingerprint("SELECT  1 -- x\nFROM t") == gate.fingerprint("select 1 from /* y */ T")
    assert gate.fingerprint("SELECT 1") != gate.fingerprint("SELECT 2") and len(gate.fingerprint("x")) == 24


def test_scans_count_the_columns_that_are_read(spark, tmp_path):
    """One column of nine: about a ninth of the file's bytes, not all; jobs over whole tables have no bound."""
    path = str(tmp_path / "wide")
    spark.range(20000).select(*[F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(9)]).coalesce(1).write.parquet(path)
    whole = sum(f.stat().st_size for f in (tmp_path / "wide").glob("*.parquet"))
    spark.read.parquet(path).createOrReplaceTempView("shop__orders_analytics")
    one, every = "SELECT max(c3) AS m FROM shop__orders_analytics", "SELECT * FROM shop__orders_analytics"
    try:
        assert whole // 10 < gate.scan_bytes(spark.sql(one)) < whole // 8 and gate.scan_bytes(spark.sql(every)) == whole
        assert gate.gated(spark, one, ALLOWED, max_bytes=whole // 2).count() == 1
        with pytest.raises(gate.Refused, match="would scan"):
            gate.gated(spark, every, ALLOWED, max_bytes=whole // 2)
        assert gate.gated(spark, every, ALLOWED, max_bytes=None).count() == gate.MAX_ROWS
    finally:
        spark.catalog.dropTempView("shop__orders_analytics")
