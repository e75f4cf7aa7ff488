"""Gold kept up to date run by run, and keys looked up in a bucketed table."""

from pyspark.sql import functions as F

from lakestrata.functions.parsing import as_day
from lakestrata.operators import gold as g
from lakestrata.operators.changes import keyed_changes
from lakestrata.session import work_folder
from lakestrata.sources.daily import DailyGold
from lakestrata.sources.runs import KeyedTable
from registry import ORACLES, register
from registry.dirty import raw_orders, raw_sql


@register("gold_incremental", ORACLES["gold_daily"])
def gold_incremental(spark, sf_dir):
    """Three runs, the later ones with late rows for days that are there, one taken twice and one that is never recorded."""
    done: list[str] = []
    gold = DailyGold(spark, work_folder(spark, "gold"), lambda: spark.createDataFrame([(r,) for r in done], "run string"))
    raw = raw_orders(spark, sf_dir)
    for run, copy_no in (("lost", 1), ("first", 0), ("second", 1), ("third", 2), ("third", 2)):
        gold.apply(g.gold_daily(raw.where(F.col("copy_no") == copy_no), as_day("order_date")), run)
        if run != "lost" and run not in done:
            done.append(run)
    return gold.read().withColumns({
        "order_date": F.col("order_date").cast("string"), "total_revenue_per_day": F.round("total_revenue_per_day", 2)})


@register("bucketed_key_lookup", raw_sql("""
SELECT order_id, product, k, copy_no FROM raw r WHERE copy_no > 0 AND order_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM raw s WHERE s.order_id = r.order_id AND s.copy_no = 0 AND s.k % 4 <> 3)"""))
def bucketed_key_lookup(spark, sf_dir):
    """Two runs fill the table; of later rows those are kept whose key it does not hold."""
    raw = raw_orders(spark, sf_dir).where("order_id IS NOT NULL").select("order_id", "product", "k", "copy_no")
    table = KeyedTable(spark, work_folder(spark, "keyed"), "order_id")
    for run, part in (("first", "k % 4 < 2"), ("second", "k % 4 = 2"), ("second", "k % 4 = 2")):
        table.write(raw.where("copy_no = 0").where(part), run)
    return table.without_known(raw.where("copy_no > 0"))


@register("version_changes", """
WITH old AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p, o_orderpriority AS r FROM orders WHERE o_orderkey % 13 <> 0),
new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS c,
               CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p, o_orderpriority AS r
        FROM orders WHERE o_orderkey % 11 <> 0),
j AS (SELECT coalesce(old.k, new.k) AS order_key, old.k IS NULL AS came, new.k IS NULL AS gone, old.p AS old_price, new.p AS new_price,
             (CASE WHEN old.c IS DISTINCT FROM new.c THEN 'customer,' ELSE '' END) ||
             (CASE WHEN old.p IS DISTINCT FROM new.p THEN 'price,' ELSE '' END) AS changed
      FROM old FULL JOIN new ON old.k = new.k)
SELECT order_key, CASE WHEN came THEN 'insert' WHEN gone THEN 'delete' ELSE 'update' END AS change,
       CASE WHEN came OR gone THEN NULL ELSE rtrim(changed, ',') END AS changed, old_price, new_price
FROM j WHERE came OR gone OR changed <> ''""")
def version_changes(spark, sf_dir):
    """Two versions of the orders, each bucketed by key: deleted, inserted and changed records and what changed in them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"))
    k = F.col("order_key")
    versions = {"old": orders.where(k % 13 != 0), "new": orders.where(k % 11 != 0).withColumns({
        "customer": F.when(k % 5 != 0, F.col("customer")), "price": F.when(k % 7 == 0, F.col("price") + 1).otherwise(F.col("price"))})}
    tables = {name: KeyedTable(spark, work_folder(spark, f"version-{name}"), "order_key") for name in versions}
    for name, table in tables.items():
        table.write(versions[name], name)
    found = keyed_changes(tables["old"].read(), tables["new"].read(), "order_key", unique=True)
    return found.select(
        "order_key", "change", F.array_join("changed", ",").alias("changed"), F.col("old.price").alias("old_price"),
        F.col("new.price").alias("new_price"))
