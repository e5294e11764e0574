from datetime import datetime

from pyspark.sql import functions as F

from linetally.env import SHUFFLE_CLEANUP, written
from linetally.workload import adapter


def test_lines_are_laid_out_by_month_before_texts_are_made(spark, tmp_path):
    day = datetime(2001, 8, 1)
    tables = {
        "nation": ([(0, "PERU"), (1, "KENYA")], "n_nationkey int, n_name string"),
        "customer": ([(7, 0), (8, 1)], "c_custkey long, c_nationkey int"),
        "orders": ([(13, 7, day), (40, 8, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "part": ([(1, "bolt")], "p_partkey long, p_name string"),
        "lineitem": (
            [(13, 1, 5, 2.0, 9.0), (40, 1, 1, 4.0, 8.0), (40, 1, 1, 4.0, 8.0)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = adapter.order_lines(spark, str(tmp_path))
    above, below = lines._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)
    for text in ("invoice_no", "stock_code", "description", "source_system", "ingested_at"):
        assert f"AS {text}#" in above and f"AS {text}#" not in below
    got = sorted((r.invoice_no, r.description, r.quantity, r.unit_price, r.customer_id, r.country) for r in lines.collect())
    assert got == [("13", " BOLT", 2, 4.5, None, "KENYA"), ("40", "bolt", 4, 2.0, "8", "KENYA"), ("40", "bolt", 4, 2.0, "8", "KENYA")]
    # an order without a date keeps its lines, and both are copied
    assert adapter.raw_orders(lines).where("partition_year IS NULL").count() == 4


def test_lines_of_an_order_are_laid_out_together(spark, tmp_path):
    """Parts are joined first, so that the last shuffle before the layout is by order; the text of the country is not moved."""
    tables = {
        "nation": "n_nationkey int, n_name string",
        "customer": "c_custkey long, c_nationkey int",
        "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
        "part": "p_partkey long, p_name string",
        "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double",
    }
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = adapter.order_lines(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions", 1)
    joins = [line for line in below.splitlines() if "Join " in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1] and "Join Inner, (country_key" in above


def test_a_write_leaves_no_shuffle_files(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f.rsplit("/", 1)[1] for f in files.split(",") if "/shuffle_" in f}

    before, setting = shuffles(), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(5, "k")
    assert written(rows, "no-shuffle-files").count() == 20_000
    rows.write.format("noop").mode("overwrite").save()  # as Spark does it
    left = {f.split("_")[1] for f in shuffles() - before}
    assert len(left) == 1 + 1  # of the count and of the plain write
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
