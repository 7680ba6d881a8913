"""Queries over two states of a table: upserts, histories, registries, work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.operators import incremental as B
from audiweave.operators import joins as J
from audiweave.operators import profile as P
from audiweave.operators import windows as H
from audiweave.plans.inputs import INDICATORS_SQL, indicators, table
from audiweave.plans.registry import query
from audiweave.sources import tables as A

OLD = "SELECT o_orderkey, o_custkey, o_orderstatus AS status, o_totalprice AS price, DATE '2001-01-01' AS last_updated_date FROM orders WHERE o_orderkey % 4 <> 0"
NEW = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 = 0"


def _states(spark, sf):
    o = table(spark, sf, "orders")
    keys = [F.col("o_orderkey"), F.col("o_custkey")]
    old = o.where("o_orderkey % 4 <> 0").select(*keys, F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.lit("2001-01-01").cast("date").alias("last_updated_date"))
    new = o.where("o_orderkey % 2 = 0 and o_custkey % 3 = 0").select(*keys, F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 6 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"))
    return old, new


@query(f"""WITH old AS ({OLD}), new AS ({NEW}), t AS (SELECT * FROM old WHERE o_custkey IN (SELECT o_custkey FROM new))
SELECT o_custkey, o_orderkey, coalesce(n.status, t.status) AS status, coalesce(n.price, t.price) AS price,
 CAST(CASE WHEN coalesce(n.status, t.status) IS NOT DISTINCT FROM t.status AND coalesce(n.price, t.price) IS NOT DISTINCT FROM t.price THEN t.last_updated_date ELSE DATE '2002-02-02' END AS VARCHAR) AS last_updated_date
FROM t FULL JOIN new n USING (o_custkey, o_orderkey)""")
def b01_upsert_change_date(spark, sf_dir):
    out = B.upsert(*_states(spark, sf_dir), "o_custkey", ["o_custkey", "o_orderkey"], "2002-02-02")
    return out.withColumn("last_updated_date", F.col("last_updated_date").cast("string"))


@query(f"WITH old AS ({OLD}), new AS ({NEW}) SELECT o_orderkey, status, price FROM old WHERE o_custkey IN (SELECT o_custkey FROM new)")
def b02_existing_of_touched(spark, sf_dir):
    return B.existing_for(*_states(spark, sf_dir), "o_custkey").select("o_orderkey", "status", "price")


@query(f"WITH old AS ({OLD}), new AS ({NEW}) SELECT o_orderkey, status, price FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)")
def b03_delete_entities(spark, sf_dir):
    return B.delete_entities(*_states(spark, sf_dir), "o_custkey").select("o_orderkey", "status", "price")


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def b04_repeated_keys(spark, sf_dir):
    return B.repeated_keys(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"])


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END, 0) AS c, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS p FROM orders")
def b05_fill_int_nulls(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return B.fill_int_nulls(o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("c"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("p")))


@query("SELECT max(o_orderdate) AS created_max, max(o_orderdate) AS updated_max, min(o_orderkey) AS id_min, max(o_orderkey) AS id_max FROM orders")
def b06_watermarks(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    mark = lambda df: B.watermarks(df, "o_orderdate", "o_orderdate", "o_orderkey")
    a, b = mark(o.where("o_custkey % 2 = 0")), mark(o.where("o_custkey % 2 = 1"))
    return B.later_of(a, b).drop("id_min").crossJoin(mark(o).select("id_min"))


@query("""WITH m AS (SELECT user_id, max(ts) - INTERVAL 1 SECOND AS a, TIMESTAMP '2024-01-31' AS e FROM events GROUP BY 1), s AS (SELECT user_id, unnest(generate_series(a, e, INTERVAL 6 HOUR)) AS f, e FROM m)
SELECT CAST(epoch_us(f) AS BIGINT) AS from_us, CAST(epoch_us(least(f + INTERVAL 6 HOUR, e)) AS BIGINT) AS to_us FROM s WHERE f < least(f + INTERVAL 6 HOUR, e)""")
def b07_slice_windows(spark, sf_dir):
    marks = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("a")).withColumn("e", F.lit("2024-01-31").cast("timestamp"))
    out = B.slice_windows(marks, "a", "e", 6)
    return out.select(F.unix_micros("from").alias("from_us"), F.unix_micros("to").alias("to_us"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def b08_keep_last(spark, sf_dir):
    return B.keep_last(table(spark, sf_dir, "orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(f"""WITH old AS ({OLD}), new AS ({NEW}) SELECT o_orderkey, status, price, false AS fresh FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT o_orderkey, status, price, true FROM new""")
def b09_rebuild(spark, sf_dir):
    old, new = _states(spark, sf_dir)
    out = B.rebuild(old, new.withColumn("fresh", F.lit(True)), "o_orderkey", "last_updated_date")
    return out.select("o_orderkey", "status", "price", F.coalesce("fresh", F.lit(False)).alias("fresh"))


@query("SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) THEN 'a' ELSE 'b' END AS tenant FROM customer")
def b10_split_by_membership(spark, sf_dir):
    members = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    a, b = B.split_by_membership(table(spark, sf_dir, "customer"), "c_nationkey", members)
    return H.union_all(a.select("c_custkey", F.lit("a").alias("tenant")), b.select("c_custkey", F.lit("b").alias("tenant")))


@query("""WITH r AS (SELECT 'shop' AS dataset, unnest(['orders', 'orders', 'parts']) AS "table", unnest(['o_orderkey', 'gone', 'p_partkey']) AS "column"), n AS (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS "column")
SELECT 'orders' AS "table", "column", x.o IS NULL AS deleted, x.r IS NULL AS added FROM (SELECT coalesce(n."column", r."column") AS "column", n."column" AS o, r."column" AS r FROM n FULL JOIN (SELECT * FROM r WHERE "table" = 'orders') r ON n."column" = r."column") x
UNION ALL SELECT 'parts', 'p_partkey', false, false""")
def b11_refresh_registry(spark, sf_dir):
    old = spark.createDataFrame([("shop", "orders", "o_orderkey"), ("shop", "orders", "gone"), ("shop", "parts", "p_partkey")], 'dataset string, `table` string, `column` string')
    old = old.withColumns({"create_date": F.lit("2000-01-01").cast("timestamp"), "update_date": F.lit("2000-01-01").cast("timestamp"), "deleted": F.lit(False)})
    out = B.refresh_registry(old, table(spark, sf_dir, "orders"), "shop", "orders", "2002-02-02")
    return out.select("table", "column", "deleted", (F.year("create_date") > 2000).alias("added"))


@query("SELECT c_custkey, NULL::VARCHAR AS title, c_acctbal FROM customer")
def b12_align(spark, sf_dir):
    from pyspark.sql.types import StructType

    return B.align(table(spark, sf_dir, "customer"), StructType.fromDDL("c_custkey bigint, title string, c_acctbal double"))


PREV = "SELECT o_custkey, min(o_orderpriority) AS value, DATE '1990-01-01' AS created_at, min(o_orderpriority) AS history FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1"


@query(f"""WITH prev AS ({PREV}), s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS c, CAST(max(o_orderdate) AS DATE) AS u FROM orders GROUP BY 1),
n AS (SELECT o_custkey, o_orderpriority AS value FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority) AS k FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED') WHERE k = 1)
SELECT n.o_custkey, n.value, CAST(coalesce(prev.created_at, s.c) AS VARCHAR) AS created_at, CAST(s.u AS VARCHAR) AS updated_at, CASE WHEN prev.history IS NULL THEN n.value ELSE prev.history || ',' || n.value END AS history
FROM n JOIN s USING (o_custkey) LEFT JOIN prev USING (o_custkey) WHERE prev.history IS NULL OR n.value IS DISTINCT FROM prev.value""")
def b14_track_history(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    prev = o.where("o_custkey % 2 = 0").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("value")).withColumns({"created_at": F.lit("1990-01-01").cast("date"), "history": F.col("value")})
    rows = o.select("o_custkey", F.col("o_orderpriority").alias("value"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"))
    out = B.track_history(prev, rows, "o_custkey", "value", ["4-NOT SPECIFIED"])
    return out.withColumns({c: F.col(c).cast("date").cast("string") for c in ("created_at", "updated_at")})


JUNK = """CASE o_orderkey % 9 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN 'TEst' WHEN 3 THEN ' ' WHEN 4 THEN '' WHEN 5 THEN ' test' WHEN 6 THEN NULL WHEN 7 THEN '???' ELSE o_orderpriority END"""


@query(f"""WITH j AS (SELECT o_orderkey, {JUNK} AS value FROM orders) SELECT o_orderkey, value FROM j WHERE value IS NULL OR value NOT IN
('', ' ', '.', '-', ',', '..', '...', '--', '/', '?', '???', 'TEST', 'TEst', 'Test', 'test', 'x', 'xx', 'xxx', 'NULL', 'none', 'None', 'NONE', 'xxxx')""")
def b15_drop_placeholders(spark, sf_dir):
    """Case and spaces count: ``null`` and `` test`` stay."""
    return B.drop_placeholders(table(spark, sf_dir, "orders").select("o_orderkey", F.expr(JUNK).alias("value")), "value")


LOG = "SELECT ts AS \"at\", event_type || '.' || CAST(user_id % 9 AS VARCHAR) AS \"table\", CASE WHEN event_id % 4 = 0 THEN 'failed' ELSE 'loaded successfully.' END AS message, 'log' || CAST(user_id % 3 AS VARCHAR) AS file, CASE WHEN event_id % 2 = 0 THEN '1,2,3' ELSE '' END AS entities FROM events"


def _log(spark, sf):
    return spark.sql(LOG.replace('"', "`").replace("FROM events", "FROM {e}").replace("VARCHAR", "STRING"), e=table(spark, sf, "events"))


@query(f"WITH l AS ({LOG}) SELECT DISTINCT \"table\" FROM l WHERE CAST(\"at\" AS DATE) > DATE '2024-01-28' AND message LIKE '%successfully.'")
def b17_tables_to_check(spark, sf_dir):
    return B.tables_to_check(_log(spark, sf_dir), "2024-01-28")


@query(f"""WITH l AS ({LOG}) SELECT file, count(DISTINCT CASE WHEN message LIKE '%successfully.' THEN "table" END) AS successful, count(DISTINCT CASE WHEN message NOT LIKE '%successfully.' THEN "table" END) AS failed,
 CAST(sum(CASE WHEN entities = '' THEN 0 ELSE 3 END) AS BIGINT) AS entities FROM l GROUP BY 1""")
def b18_log_digest(spark, sf_dir):
    return B.log_digest(_log(spark, sf_dir))


@query("""WITH o AS (SELECT o_custkey, max(o_orderpriority) AS v FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1), n AS (SELECT o_custkey, max(o_orderpriority) AS v FROM orders GROUP BY 1)
SELECT o_custkey, n.v AS v FROM n LEFT JOIN o USING (o_custkey) WHERE o.v IS DISTINCT FROM n.v""")
def b20_append_changed(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    best = lambda df: df.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("v"))
    return B.append_changed(best(o.where("year(o_orderdate) < 1998")), best(o), ["o_custkey"], "v")


@query("SELECT DISTINCT p_name || ' ' || lower(p_type) AS name, replace(p_name || ' ' || lower(p_type), ' ', '_') AS clean FROM part WHERE p_name || ' ' || lower(p_type) NOT IN (SELECT p_name || ' ' || lower(p_type) FROM part WHERE p_size > 40)")
def b22_extend_names(spark, sf_dir):
    """Names known from large parts, extended by those of all parts."""
    p = table(spark, sf_dir, "part").withColumn("name", F.concat_ws(" ", "p_name", F.lower("p_type")))
    return B.extend_names(p.where("p_size > 40"), p, "name", C.slug)


@query("SELECT o_custkey, rows, CAST(floor((sum(rows) OVER (ORDER BY o_custkey) - 1) / 100) AS BIGINT) AS chunk FROM (SELECT o_custkey, count(*) AS rows FROM orders GROUP BY 1)")
def b23_chunk_groups(spark, sf_dir):
    return B.chunk_groups(table(spark, sf_dir, "orders"), "o_custkey", 100)


@query("SELECT c_custkey AS token, c_name, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS calls FROM customer")
def b24_usage_by_token(spark, sf_dir):
    tokens = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("token"), "c_name")
    return B.usage_by_token(table(spark, sf_dir, "events").select(F.col("user_id").alias("token")), tokens)


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id < 5000)")
def b25_since_last(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return B.since_last(ev, ev.where("event_id < 5000"), "ts").select("event_id")


@query("SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def b26_missing_ids(spark, sf_dir):
    """Customers without any order."""
    return B.missing_ids(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def b27_changed_ids(spark, sf_dir):
    return B.changed_ids(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "2001-01-01")


@query("SELECT DISTINCT c_custkey AS id, 'listed' AS side FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) UNION ALL SELECT DISTINCT user_id, 'loaded' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)")
def b28_coverage_gap(spark, sf_dir):
    return B.coverage_gap(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "events").select(F.col("user_id").alias("id")), "id")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def a04_read_table(spark, sf_dir):
    at = A.Warehouse(spark, sf_dir)
    return at.spark.read.parquet(f"{at.root}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders")
def a11_plain_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", A.plain_date(F.col("d")).cast("string").alias("date"))


@query("SELECT (SELECT max(o_orderdate) FROM orders) > (SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 2 = 0 AND year(o_orderdate) < 2000) AS newer, count(*) AS n FROM orders")
def a12_freshness(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    newer = A.is_newer(o, o.where("o_orderkey % 2 = 0 and year(o_orderdate) < 2000"), "o_orderdate")
    return o.agg(F.lit(newer).alias("newer"), F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || chr(31) || '0'), 1, 15))::BIGINT LIMIT 1000")
def a17_cap_rows(spark, sf_dir):
    return A.cap_rows(table(spark, sf_dir, "orders"), 1000, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("""SELECT c.id, coalesce(CASE WHEN c.id % 2 = 1 THEN c.name END, s.name) AS name, c_acctbal, s_acctbal FROM (SELECT c_custkey + 1 AS id, c_name AS name, c_acctbal FROM customer) c JOIN (SELECT s_suppkey + 1 AS id, s_name AS name, s_acctbal FROM supplier) s USING (id)
UNION ALL SELECT c_custkey + 1, CASE WHEN c_custkey % 2 = 0 THEN c_name END, c_acctbal, NULL FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT s_suppkey + 1, s_name, NULL, s_acctbal FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""")
def f03_unify_identities(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).cast("string").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), "c_acctbal")
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).cast("string").alias("id"), F.col("s_name").alias("name"), "s_acctbal")
    return J.unify_identities(a, b, "id").withColumn("id", F.col("id").cast("long"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def f04_members(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return J.members(table(spark, sf_dir, "orders"), ids, "o_custkey").select("o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderdate) IN (SELECT (o_custkey, max(o_orderdate)) FROM orders GROUP BY o_custkey)")
def f05_latest_snapshot(spark, sf_dir):
    return H.latest_snapshot(table(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)")
def f06_baseline_snapshot(spark, sf_dir):
    return H.baseline_snapshot(table(spark, sf_dir, "orders"), "o_orderdate").select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def f08_with_dimensions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    c, n, r = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return J.with_dimensions(o, (c, "c_custkey"), (n, "n_nationkey"), (r, "n_regionkey")).select("o_orderkey", "n_name", "r_name")


@query("SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey OR o_custkey = c_custkey + 1")
def f09_join_either(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("k2", F.col("c_custkey") + 1)
    return J.join_either(table(spark, sf_dir, "orders"), c, "c_custkey", "k2", "o_custkey").select("o_orderkey", "c_custkey")


@query("SELECT p_partkey, coalesce(CASE p_brand WHEN 'Brand#1' THEN 'First' WHEN 'Brand#11' THEN 'Eleventh' END, p_brand) AS p_brand FROM part")
def f11_replace_by_lookup(spark, sf_dir):
    lut = spark.createDataFrame([("Brand#1", "First"), ("Brand#11", "Eleventh")], "short string, full string")
    return J.replace_by_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), lut, "p_brand", "short", "full")


@query("SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) THEN o_orderpriority END AS priority FROM orders")
def f12_mask_by_list(spark, sf_dir):
    allowed = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority"))
    return J.mask_by_list(o, allowed, "o_custkey", "priority").select("o_orderkey", "priority")


@query("""SELECT c_custkey AS user_id, n, m, s FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey) LEFT JOIN (SELECT user_id AS c_custkey, count(*) AS m FROM events GROUP BY 1) USING (c_custkey) LEFT JOIN (SELECT s_suppkey AS c_custkey, s_name AS s FROM supplier) USING (c_custkey)""")
def f13_attribute_stack(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    parts = [table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n")), table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("m"))]
    return J.attribute_stack(base, *parts, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("s")))


@query("SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus")
def f15_join_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").withColumns({"k": F.col("l_orderkey"), "s": F.col("l_linestatus")})
    return J.join_keys(li, o, ["k", "s"]).select("l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus")


@query("SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier UNION ALL SELECT n_name, n_nationkey FROM nation")
def j01_union_all(spark, sf_dir):
    own = lambda t, a, b: table(spark, sf_dir, t).select(F.col(a).alias("name"), F.col(b).alias("nation"))
    return H.union_all(own("customer", "c_name", "c_nationkey"), own("supplier", "s_name", "s_nationkey"), own("nation", "n_name", "n_nationkey"))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def j02_union_distinct(spark, sf_dir):
    return H.union_distinct(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE (l_partkey, l_suppkey) NOT IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_returnflag = 'R')")
def j03_minus(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return H.minus(li.select("l_partkey", "l_suppkey").distinct(), li.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


_COLS = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]
_HEALTH = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(count({c}) / count(*), 4) AS coverage, "
    + (f"round(max(abs({c} - m) / s), 4) AS max_z FROM l, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM l)" if c != "l_returnflag" else "NULL AS max_z FROM l")
    for c in _COLS
)


@query(f"WITH l AS (SELECT l_orderkey, CASE WHEN l_linenumber > 1 THEN l_quantity END AS l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem) {_HEALTH}")
def g19_health_check(spark, sf_dir):
    """G16, G18, G19."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")))
    return P.health_check(li.select(*_COLS), "shop", "lineitem").select("column", "coverage", "max_z")


@query("""WITH z AS (SELECT l_extendedprice AS value, (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS z FROM lineitem)
SELECT 'l_extendedprice' AS "column", CAST(rank AS INTEGER) AS rank, value, round(z, 4) AS z FROM (SELECT *, row_number() OVER (ORDER BY abs(z) DESC, value DESC) AS rank FROM z) WHERE rank <= 5""")
def g18_top_z(spark, sf_dir):
    return P.top_z(table(spark, sf_dir, "lineitem").select("l_extendedprice"), 5).withColumn("z", F.round("z", 4))


@query()
def g17_samples(spark, sf_dir):
    return P.samples(table(spark, sf_dir, "lineitem"), 20)


@query(f"""WITH i AS ({INDICATORS_SQL}), n AS (SELECT country, indicator, year, value + 1 AS value FROM i WHERE year >= 2000), o AS (SELECT country, indicator, year, value FROM i WHERE year <= 2000)
SELECT coalesce(o.country, n.country) AS country, coalesce(o.year, n.year) AS year, round(coalesce(n.value, o.value), 2) AS value, CASE WHEN n.value IS NULL THEN '2001-01-01' ELSE '2002-02-02' END AS last_updated_date
FROM o FULL JOIN n ON o.country = n.country AND o.year = n.year""")
def n14_economics_upsert(spark, sf_dir):
    """N14 with D1, B1: a nested yearly series into a fact table."""
    from audiweave.operators.audience import economics_upsert

    i = indicators(spark, sf_dir)
    old = i.where("year <= 2000").select("country", "indicator", "year", "value", F.lit("2001-01-01").cast("date").alias("last_updated_date"))
    payload = i.where("year >= 2000").groupBy("country").agg(F.collect_list(F.struct("indicator", "year", (F.col("value") + 1).alias("value"))).alias("series"))
    out = economics_upsert(old, payload, "2002-02-02")
    return out.select("country", "year", F.round("value", 2).alias("value"), F.col("last_updated_date").cast("string").alias("last_updated_date"))


@query("""SELECT 'l_quantity' AS "column", round(count(CASE WHEN l_linenumber > 1 THEN 1 END) / count(*), 6) AS coverage FROM lineitem UNION ALL SELECT 'l_orderkey', 1.0""")
def g16_coverage(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("l_quantity"))
    return P.coverage(li).select("column", F.round("coverage", 6).alias("coverage"))


@query("SELECT o_orderkey, o_orderpriority AS pf_code, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND year(o_orderdate) > 1995")
def c37_trade_scope(spark, sf_dir):
    from audiweave.operators.audience import trade_scope

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("pf_code"), F.year("o_orderdate").alias("yr"))
    return trade_scope(o, ("1-URGENT", "5-LOW"), 1995)
