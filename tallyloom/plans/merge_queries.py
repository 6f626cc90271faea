"""Merges, change capture, snapshots, reconciliation, levels. Changes are derived from the orders themselves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import graph, merge, reconcile, snapshots
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path
from tallyloom.sources import key_index
from tallyloom.sources.readers import load, register
from tallyloom.sources.writers import write_partitioned

NOON = dt.datetime(2024, 6, 1, 12, 0, 0)
EARLIER = dt.datetime(2024, 1, 1)


@query(
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 2 AS DOUBLE) ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'UPDATED' ELSE o_orderpriority END AS o_orderpriority FROM orders"""
)
def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderpriority")
    updates = orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"), F.lit("UPDATED").alias("flag"))
    return merge.merge_update(orders, updates, ["o_orderkey"], {"o_totalprice": "price", "o_orderpriority": "flag"})


CUT = dt.datetime(2000, 1, 1)


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to the end of 1999, with the stamps of an earlier load."""
    orders = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
    stamp = F.lit(EARLIER).cast("timestamp")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("timestamp"), stamp.alias("created_at"), stamp.alias("updated_at"), "o_orderpriority"
    )


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order twice: once at its own date, once a day later (finished orders) or earlier (the others)."""
    day = F.when(F.col("o_orderstatus") == "F", F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL -1 DAY"))
    row = lambda value, ts: F.struct(F.col("o_orderkey").alias("id"), value.alias("value"), ts.alias("timestamp"), "o_orderpriority")
    return load(spark, sf_dir, "orders").select(
        F.inline(F.array(row(F.lit(1.5), F.col("o_orderdate")), row(F.col("o_totalprice") + 1, F.col("o_orderdate") + day)))
    )


UPSERT_SQL = """WITH t AS (SELECT o_orderkey AS id, o_totalprice AS value, o_orderdate AS timestamp, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
  s0 AS (SELECT o_orderkey AS id, 1.5::DOUBLE AS value, o_orderdate AS timestamp, o_orderpriority FROM orders
         UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 1 DAY ELSE INTERVAL (-1) DAY END, o_orderpriority FROM orders),
  s AS (SELECT id, value, timestamp, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, value DESC) AS n FROM s0) WHERE n = 1)
  SELECT coalesce(t.id, s.id) AS id,
         CASE WHEN t.id IS NULL OR s.timestamp > t.timestamp THEN s.value ELSE t.value END AS value,
         CASE WHEN t.id IS NULL OR s.timestamp > t.timestamp THEN s.timestamp ELSE t.timestamp END AS timestamp,
         CASE WHEN t.id IS NULL THEN TIMESTAMP '2024-06-01 12:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at,
         CASE WHEN t.id IS NULL OR s.timestamp > t.timestamp THEN TIMESTAMP '2024-06-01 12:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at,
         coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
  FROM t FULL JOIN s ON t.id = s.id"""


@query(UPSERT_SQL)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert(_target(spark, sf_dir), _incoming(spark, sf_dir), ["id"], now=NOON)


@query(UPSERT_SQL)
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert against a table partitioned by priority, rewriting touched partitions only."""
    path, by = scratch_path(spark, "upsert-table"), ["o_orderpriority"]
    write_partitioned(_target(spark, sf_dir), path, by)
    merge.upsert_partitions(spark, path, _incoming(spark, sf_dir), ["id"], by, now=NOON, tiebreak=["value"])
    return spark.read.parquet(path)


@query(
    """SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS year FROM orders
    WHERE year(o_orderdate) = (SELECT min(year(o_orderdate)) FROM orders) AND o_orderstatus = 'F'"""
)
def moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders of the first year, asked for as if they belonged to the year after: the rows a merge would refuse, found
    through the key index in the first year's folder alone."""
    path, by, keys = scratch_path(spark, "moved"), ["year"], ["o_orderkey"]
    orders = load(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    write_partitioned(orders.select("o_orderkey", "o_totalprice", "year"), path, by)
    first = orders.agg(F.min("year")).first()[0] or 0
    wanted = orders.filter((F.col("year") == first) & (F.col("o_orderstatus") == "F")).select(*keys)
    key_index.refresh(spark, path, keys, by)
    found = key_index.rows_elsewhere(spark, path, wanted, keys, by, F.col("year") == first + 1)
    return spark.read.parquet(path).limit(0) if found is None else found


@query(
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'refused' ELSE 'merged' END AS outcome, count(*) AS rows, count(*) FILTER (year(o_orderdate) = 1996) AS in_1996
    FROM orders GROUP BY 1"""
)
def refused_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year: finished ones come again under another year and are refused, the others under their own."""
    path, by = scratch_path(spark, "refused"), ["year"]
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_orderstatus", F.col("o_orderdate").alias("timestamp"), F.year("o_orderdate").alias("year")
    )
    write_partitioned(orders, path, by)
    done = F.col("o_orderstatus") == "F"
    newer = orders.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    merge.upsert_partitions(spark, path, newer.filter(~done), ["id"], by)
    try:
        merge.upsert_partitions(spark, path, newer.filter(done).withColumn("year", F.lit(9999)), ["id"], by)
        refused = False
    except ValueError:
        refused = True
    state = spark.read.parquet(path)
    outcome = F.when(done & F.lit(refused), "refused").otherwise("merged").alias("outcome")
    return state.groupBy(outcome).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("year") == 1996).alias("in_1996"))


ROW = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes as JSON: an update for every order, then for open orders a delete and a create under a new key."""
    orders = load(spark, sf_dir, "orders")
    image = lambda key, status, price: F.struct(key.alias("o_orderkey"), status.alias("o_orderstatus"), price.alias("o_totalprice"))
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    none = F.lit(None).cast(f"struct<{ROW.replace(' ', ':').replace(',:', ',')}>")
    change = lambda before, after, op, ts: F.struct(
        F.col("o_orderkey"), F.to_json(F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"), F.lit(ts).cast("long").alias("ts_ms"))).alias("value")
    )
    old = image(key, F.col("o_orderstatus"), price)
    changes = F.array(
        change(old, image(key, F.lit("U"), price * 2), "u", 1_700_000_000_000),
        change(old, none, "d", 1_700_000_001_000),
        change(none, image(-key - 1, F.lit("N"), price), "c", 1_700_000_002_000),
    )
    is_open = F.col("o_orderstatus") == "O"
    return orders.select(F.inline(F.when(is_open, changes).otherwise(F.slice(changes, 1, 1)))).select("value")


@query(
    """SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, 'u' AS operation, make_timestamp(1700000000000000) AS changed_at FROM orders
    UNION ALL SELECT o_orderkey, NULL, NULL, 'd', make_timestamp(1700000001000000) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT -o_orderkey - 1, 'N', o_totalprice, 'c', make_timestamp(1700000002000000) FROM orders WHERE o_orderstatus = 'O'"""
)
def flatten_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.flatten_cdc(order_envelopes(spark, sf_dir), ROW, ["o_orderkey"])


CDC_SQL = """SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT -o_orderkey - 1, 'N', o_totalprice FROM orders WHERE o_orderstatus = 'O'"""


@query(CDC_SQL)
def apply_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changes = merge.flatten_cdc(order_envelopes(spark, sf_dir), ROW, ["o_orderkey"])
    return merge.apply_cdc(target, changes, ["o_orderkey"])


@query("SELECT n_nationkey, n_name, NULL::VARCHAR AS continent, r_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier")
def evolve_and_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = merge.evolve(nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", "r_name"), {"continent": "string"})
    supplier = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("n_nationkey"), F.col("s_name").alias("n_name"))
    return reconcile.combine([nation, supplier]).select("n_nationkey", "n_name", "continent", "r_name")


@query("SELECT CAST(version AS BIGINT) AS version, CASE version WHEN 0 THEN 'LOAD' ELSE 'PRUNE' END AS operation, (SELECT count(*) FROM orders WHERE version = 0 OR o_orderstatus = 'F') AS rows FROM (SELECT unnest([0, 1]) AS version)")
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    orders = load(spark, sf_dir, "orders")
    snapshots.write_snapshot(orders, path, "LOAD")
    snapshots.write_snapshot(orders.filter(F.col("o_orderstatus") == "F"), path, "PRUNE")
    return snapshots.history(spark, path).select("version", "operation", "rows")


@query("SELECT * FROM orders")
def read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    orders = load(spark, sf_dir, "orders")
    snapshots.write_snapshot(orders, path, "LOAD")
    snapshots.write_snapshot(orders.filter(F.col("o_orderstatus") == "F"), path, "PRUNE")
    return snapshots.read_as_of(spark, path, 0)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def refused_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers of version 1: the second is refused, and the first one's rows are intact."""
    path = scratch_path(spark, "snapshots")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    by_status = lambda s: load(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == s).select(*orders.columns)
    snapshots.write_snapshot(orders, path, "LOAD")
    snapshots.write_snapshot(by_status("O"), path, "OPEN", version=1)
    try:
        snapshots.write_snapshot(by_status("F"), path, "DONE", version=1)
    except snapshots.VersionTaken:
        return snapshots.read_as_of(spark, path)
    raise AssertionError("the second writer of a version was not refused")


@query("SELECT count(*) AS source_count, count(*) AS plain_count, count(*) AS partitioned_count, count(DISTINCT o_orderpriority) AS groups, 0::BIGINT AS groups_differing, true AS matches FROM orders")
def migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    register(spark, {"orders_to_migrate": exact})
    report = snapshots.migrate(spark, "orders_to_migrate", scratch_path(spark, "migrated"), ["o_orderstatus"], "o_orderpriority", "o_totalprice")
    return report.drop("source", "target")


_SHIFTED = "SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW' OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'))"


def _shifted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    priority = F.col("o_orderpriority")
    return orders, orders.filter(~((priority == "5-LOW") | ((priority == "1-URGENT") & (F.col("o_orderstatus") == "O"))))


@query(
    f"""WITH a AS (SELECT o_orderpriority AS g, count(*) AS c, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS t FROM orders GROUP BY 1),
    b AS (SELECT o_orderpriority AS g, count(*) AS c, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS t FROM ({_SHIFTED}) GROUP BY 1)
    SELECT coalesce(a.g, b.g) AS o_orderpriority, coalesce(a.c, 0) AS left_count, coalesce(b.c, 0) AS right_count, CAST(a.t AS DOUBLE) AS left_total,
           CAST(b.t AS DOUBLE) AS right_total, a.c IS NOT DISTINCT FROM b.c AND a.t IS NOT DISTINCT FROM b.t AS matches
    FROM a FULL JOIN b ON a.g = b.g"""
)
def reconcile_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(*_shifted(spark, sf_dir), "o_orderpriority", "o_totalprice")


@query(f"WITH b AS ({_SHIFTED}) SELECT (SELECT count(*) FROM orders) AS left_count, (SELECT count(*) FROM b) AS right_count, (SELECT count(*) FROM orders) = (SELECT count(*) FROM b) AS matches")
def count_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.count_match(*_shifted(spark, sf_dir))


@query(
    """WITH a AS (SELECT l_returnflag AS f, l_linestatus AS s, l_linenumber AS n FROM lineitem),
    b AS (SELECT l_returnflag AS f, l_linestatus AS s, l_linenumber AS n FROM lineitem WHERE l_quantity < 40),
    d AS (SELECT f, s, n, sum(w) AS c FROM (SELECT *, 1 AS w FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY f, s, n)
    SELECT f, s, n, CAST(abs(c) AS BIGINT) AS copies, CASE WHEN c > 0 THEN 'left' ELSE 'right' END AS side FROM d WHERE c <> 0"""
)
def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s"), F.col("l_linenumber").alias("n"), "l_quantity")
    return reconcile.row_diff(rows.drop("l_quantity"), rows.filter(F.col("l_quantity") < 40).drop("l_quantity"))


COMPARE_SQL = """WITH b AS (SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey,
                      c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment = 'BUILDING' AS raised
               FROM customer WHERE c_nationkey <> 3)
    SELECT 'schema_equal' AS item, 4::BIGINT AS left_value, 4::BIGINT AS right_value, true AS matches
    UNION ALL SELECT 'rows', (SELECT count(*) FROM customer), (SELECT count(*) FROM b), (SELECT count(*) FROM customer) = (SELECT count(*) FROM b)
    UNION ALL SELECT 'nulls:c_custkey', 0, 0, true UNION ALL SELECT 'nulls:c_acctbal', 0, 0, true UNION ALL SELECT 'nulls:c_nationkey', 0, 0, true
    UNION ALL SELECT 'nulls:c_mktsegment', 0, (SELECT count(*) FROM b WHERE c_mktsegment IS NULL), (SELECT count(*) FROM b WHERE c_mktsegment IS NULL) = 0
    UNION ALL SELECT 'keys_only_here', (SELECT count(*) FROM customer WHERE c_nationkey = 3), 0, (SELECT count(*) FROM customer WHERE c_nationkey = 3) = 0
    UNION ALL SELECT 'duplicate_keys', 0, 0, true UNION ALL SELECT 'different:c_nationkey', 0, 0, true
    UNION ALL SELECT 'different:c_mktsegment', count(*), count(*), count(*) = 0 FROM b WHERE c_mktsegment IS NULL
    UNION ALL SELECT 'different:c_acctbal', count(*), count(*), count(*) = 0 FROM b WHERE raised"""


def _two_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    nation, market = F.col("c_nationkey"), F.col("c_mktsegment")
    b = a.filter(nation != 3).select(
        "c_custkey",
        F.when(nation != 7, market).alias("c_mktsegment"),
        "c_nationkey",
        (F.col("c_acctbal") + F.when(market == "BUILDING", 1).otherwise(0)).alias("c_acctbal"),
    )
    return a, b


@query(COMPARE_SQL)
def compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.compare(*_two_customers(spark, sf_dir), "c_custkey", 0.01)


@query(COMPARE_SQL)
def compare_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same comparison, with only the rows of differing key buckets joined."""
    return reconcile.compare(*_two_customers(spark, sf_dir), "c_custkey", 0.01, digests=True)


@query(
    """WITH RECURSIVE e AS (SELECT concat('o', o_orderkey) AS src, concat('c', o_custkey) AS dst FROM orders
       UNION SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer
       UNION SELECT concat('s', s_suppkey), concat('n', s_nationkey) FROM supplier
       UNION SELECT concat('n', n_nationkey), concat('r', n_regionkey) FROM nation),
    ids AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
    p(id, level) AS (SELECT id, 0 FROM ids UNION SELECT e.dst, p.level + 1 FROM p JOIN e ON p.id = e.src)
    SELECT id, CAST(max(level) AS INTEGER) AS level FROM p GROUP BY id"""
)
def dag_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    def side(table: str, src: tuple[str, str], dst: tuple[str, str]) -> DataFrame:
        node = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
        return load(spark, sf_dir, table).select(node(*src).alias("src"), node(*dst).alias("dst"))

    edges = reconcile.combine(
        [
            side("orders", ("o", "o_orderkey"), ("c", "o_custkey")),
            side("customer", ("c", "c_custkey"), ("n", "c_nationkey")),
            side("supplier", ("s", "s_suppkey"), ("n", "s_nationkey")),
            side("nation", ("n", "n_nationkey"), ("r", "n_regionkey")),
        ]
    )
    return graph.dag_levels(edges, edges.select(F.col("src").alias("id")))
