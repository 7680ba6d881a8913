"""Queries that write tables, files or streams and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from audiweave.functions.time import micros
from audiweave.operators import incremental as B
from audiweave.operators import nested as D
from audiweave.plans.inputs import SEGMENTS_SQL, VIEWS_SQL, segments, table, views
from audiweave.plans.loads import NEW, OLD, _states
from audiweave.plans.registry import query
from audiweave.sources.buckets import EntityTable
from audiweave.sources import tables as A
from audiweave.sources.scratch import shared_folder
from audiweave.streaming import streams as O


def house(spark) -> A.Warehouse:
    """A new warehouse in the shared folder."""
    return A.Warehouse(spark, f"{shared_folder(spark)}/house-{uuid.uuid4().hex}")


NATIONS = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
CUSTOMERS = "SELECT c_custkey, c_name, c_acctbal FROM customer"


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


@query(CUSTOMERS)
def a02_load_if_absent(spark, sf_dir):
    """The second load changes nothing."""
    at, c = house(spark), _customers(spark, sf_dir)
    at.load_if_absent(c, "shop", "customer")
    at.load_if_absent(c.limit(1), "shop", "customer")
    return at.read("shop", "customer")


@query(f"{CUSTOMERS} UNION ALL {CUSTOMERS}")
def a03_write_table(spark, sf_dir):
    """Append, then an overwrite that reads what it replaces."""
    at, c = house(spark), _customers(spark, sf_dir)
    at.write(c.withColumn("c_custkey", F.col("c_custkey").cast("int")), "shop", "customer", schema=StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double"))
    at.write(at.read("shop", "customer").union(c), "shop", "customer", "overwrite")
    return at.read("shop", "customer")


@query(f"{CUSTOMERS} WHERE c_custkey % 2 = 0")
def a06_drop_table(spark, sf_dir):
    at, c = house(spark), _customers(spark, sf_dir)
    at.write(c, "shop", "customer")
    at.drop("shop", "customer")
    at.drop("shop", "customer")
    at.write(c.where("c_custkey % 2 = 0"), "shop", "customer")
    return at.read("shop", "customer")


@query(CUSTOMERS)
def a07_replace_snapshot(spark, sf_dir):
    """An empty snapshot replaces nothing."""
    at, c = house(spark), _customers(spark, sf_dir)
    at.replace_snapshot(c.limit(3), "shop", "customer")
    at.replace_snapshot(c, "shop", "customer")
    at.replace_snapshot(c.limit(0), "shop", "customer")
    return at.read("shop", "customer")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def a09_json_pages(spark, sf_dir):
    """Landed pages of records."""
    at = f"{house(spark).root}/pages"
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("data"))
    o.write.json(at)
    pages = spark.read.json(at, schema="o_custkey long, data array<struct<o_orderkey:long,o_totalprice:double>>")
    return D.explode_records(pages, "data", ["o_custkey"])


@query(NATIONS)
def a10_xml_pages(spark, sf_dir):
    at = f"{house(spark).root}/xml"
    table(spark, sf_dir, "nation").write.format("xml").option("rowTag", "nation").option("rootTag", "page").save(at)
    return A.read_xml_pages(spark, at, "nation", "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT o_orderkey, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders")
def a11_csv_set(spark, sf_dir):
    at = f"{house(spark).root}/orders"
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("O-OrderKey"), F.col("o_orderpriority").alias("o_orderpriority "), F.date_format("o_orderdate", "yyyyMMdd").alias("Date"))
    o.write.option("header", True).csv(at)
    got = A.load_csv_set(spark, {"orders": at})["orders"]
    return got.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", F.col("date").cast("string").alias("date"))


@query(CUSTOMERS)
def a13_export_table(spark, sf_dir):
    at = f"{house(spark).root}/export"
    A.export_table(_customers(spark, sf_dir), at, "csv")
    return spark.read.csv(at, header=True, schema="c_custkey bigint, c_name string, c_acctbal double")


@query("""SELECT 'shop' AS dataset, t AS "table", c AS "column", y AS type, (SELECT count(*) FROM customer) AS n FROM (SELECT unnest(['customer', 'customer', 'customer', 'nation', 'nation', 'nation']) AS t, unnest(['c_custkey', 'c_name', 'c_acctbal', 'n_nationkey', 'n_name', 'n_regionkey']) AS c, unnest(['bigint', 'string', 'double', 'int', 'string', 'int']) AS y)""")
def a14_catalog(spark, sf_dir):
    at, c = house(spark), _customers(spark, sf_dir)
    at.write(c, "shop", "customer")
    at.write(table(spark, sf_dir, "nation"), "shop", "nation")
    return at.catalog().crossJoin(at.read("shop", "customer").agg(F.count("*").alias("n")))


@query("SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY 1")
def a15_staged(spark, sf_dir):
    c = A.staged(table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal"))
    counts = c.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return counts.join(c.groupBy("c_nationkey").agg(F.round(F.avg("c_acctbal"), 4).alias("mean")), "c_nationkey")


@query("SELECT user_id, count(*) AS n, 'd1' AS day FROM events GROUP BY 1")
def a16_cached_features(spark, sf_dir):
    """Built for the first key, reused the second time."""
    at, ev = house(spark), table(spark, sf_dir, "events")
    build = lambda: ev.groupBy("user_id").agg(F.count("*").alias("n"))
    at.cached("features", "views", {"day": "d1"}, build)
    at.cached("features", "views", {"day": "d2"}, build)
    return at.cached("features", "views", {"day": "d1"}, lambda: build().limit(0))


@query("SELECT true AS same, false AS other, count(*) AS n FROM customer")
def b13_schema_matches(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    same, other = (B.schema_matches(c, StructType.fromDDL(x)) for x in ("c_custkey bigint, c_name string", "c_custkey int"))
    return c.agg(F.lit(same).alias("same"), F.lit(other).alias("other"), F.count("*").alias("n"))


@query("""SELECT event_type AS "table", 'loaded ' || CAST(count(*) AS VARCHAR) || ' successfully.' AS message FROM events GROUP BY 1""")
def b16_log_run(spark, sf_dir):
    at = house(spark)
    runs = table(spark, sf_dir, "events").groupBy("event_type").count()
    at.log_runs(runs.select(F.lit("2024-01-01").alias("at"), F.concat(F.lit("shop."), "event_type").alias("table"), F.format_string("loaded %d successfully.", "count").alias("message")))
    return at.read("runs", "log").select(F.regexp_replace("table", "^shop[.]", "").alias("table"), "message")


@query("SELECT event_id, CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-10' THEN 1 ELSE 3 END AS run FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'")
def b19_checkpoint(spark, sf_dir):
    """Three runs load what lies between the committed date and their own; the second fails and is rolled back, so the third loads its rows."""
    at = B.Checkpoint(house(spark))
    ev = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    loaded = []
    for run, (date, fails) in enumerate([("2024-01-10", False), ("2024-01-20", True), ("2024-01-20", False)], 1):
        at.begin("views", date)
        committed, pending = at.get("views")
        rows = ev.where(F.col("day") <= F.lit(pending).cast("date"))
        rows = rows if committed is None else rows.where(F.col("day") > F.lit(committed).cast("date"))
        if fails:
            at.rollback("views")
        else:
            loaded.append(rows.select("event_id", F.lit(run).alias("run")))
            at.commit("views")
    return loaded[0].union(loaded[1])


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'first' ELSE 'second' END AS run FROM orders")
def b21_append_once(spark, sf_dir):
    """The second run adds only customers that the first left out."""
    at, o = house(spark), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    at.append_once(o.where("o_custkey % 3 = 0").withColumn("run", F.lit("first")), "shop", "orders", ["o_custkey"])
    at.append_once(o.withColumn("run", F.lit("second")), "shop", "orders", ["o_custkey"])
    return at.read("shop", "orders")


@query(CUSTOMERS)
def o01_stream_landing(spark, sf_dir):
    """Started twice; each file arrives once."""
    root = house(spark).root
    _customers(spark, sf_dir).write.option("header", True).csv(f"{root}/in")
    for _ in range(2):
        O.stream_landing(spark, f"{root}/in", "c_custkey bigint, c_name string, c_acctbal double", f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(f"WITH v AS ({VIEWS_SQL}), g AS ({SEGMENTS_SQL}) SELECT event_id, g.cluster, g.cluster IS NULL AS soft FROM v LEFT JOIN g USING (user_id, site)")
def o02_stream_segments(spark, sf_dir):
    return O.stream_segments(views(spark, sf_dir), segments(spark, sf_dir)).select("event_id", "cluster", "soft")


@query("""WITH d AS (SELECT DISTINCT user_id, event_type AS site, CAST(ts AS DATE) AS day FROM events)
SELECT CAST(day AS VARCHAR) AS day, site, count(*) AS visitors, count(*) FILTER (EXISTS (SELECT 1 FROM d AS e WHERE e.user_id = d.user_id AND e.site = d.site AND e.day < d.day AND e.day >= d.day - 30)) AS returning_visitors FROM d GROUP BY 1, 2""")
def o03_daily_visitors(spark, sf_dir):
    """A stream over two landings, the second with late events; then the count."""
    at = house(spark)
    ev = views(spark, sf_dir).select("user_id", "site", F.col("ts").cast("timestamp").alias("ts"))
    for part in (ev.where("user_id % 3 > 0"), ev):
        part.write.mode("append").parquet(f"{at.root}/views")
        O.stream_seen(spark.readStream.schema(part.schema).parquet(f"{at.root}/views"), at, "shop", "seen", f"{at.root}/seen-state").awaitTermination()
    return O.daily_visitors(at.read("shop", "seen")).withColumn("day", F.col("day").cast("string"))


@query("""WITH d AS (SELECT DISTINCT user_id, event_type AS site, CAST(ts AS DATE) AS day FROM events)
SELECT CAST(day AS VARCHAR) AS day, site, count(*) AS visitors, count(*) FILTER (EXISTS (SELECT 1 FROM d AS e WHERE e.user_id = d.user_id AND e.site = d.site AND e.day < d.day AND e.day >= d.day - 7)) AS returning_visitors FROM d WHERE day >= DATE '2024-01-15' GROUP BY 1, 2""")
def o03_watermarked_visitors(spark, sf_dir):
    """Views land ten days at a time and pass the watermarked stream; then a part of the days is counted."""
    at = house(spark)
    ev = views(spark, sf_dir).select("user_id", "site", F.col("ts").cast("timestamp").alias("ts"))
    for first, last in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        ev.where((F.col("ts") >= F.lit(first).cast("timestamp")) & (F.col("ts") < F.lit(last).cast("timestamp"))).write.mode("append").parquet(f"{at.root}/views")
        O.stream_visitors(spark.readStream.schema(ev.schema).parquet(f"{at.root}/views"), at, "shop", "seen", f"{at.root}/state").awaitTermination()
    return O.daily_visitors(at.read("shop", "seen"), 7, first="2024-01-15").withColumn("day", F.col("day").cast("string"))


@query("""WITH l AS (SELECT user_id, event_type AS site, user_id % 4 AS cluster, max(ts) AS m FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3), n AS (SELECT user_id, event_type AS site, CASE WHEN user_id % 5 = 0 THEN 9 ELSE user_id % 4 END AS cluster FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3)
SELECT user_id, site, cluster FROM l UNION ALL SELECT n.user_id, n.site, n.cluster FROM n LEFT JOIN l USING (user_id, site) WHERE l.cluster IS DISTINCT FROM n.cluster""")
def o04_stream_changes(spark, sf_dir):
    """Two micro-batches of predictions; only changes are appended."""
    at = house(spark)
    ev = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("site"), F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    pred = ev.withColumn("cluster", F.when(~early & (F.col("user_id") % 5 == 0), 9).otherwise(F.col("user_id") % 4).cast("int"))
    last = lambda df: df.groupBy("user_id", "site").agg(F.max("cluster").alias("cluster"), F.max("ts").alias("ts"))
    for part in (pred.where(early), pred.where(~early)):
        last(part).write.mode("append").parquet(f"{at.root}/pred")
        O.stream_changes(spark.readStream.schema("user_id long, site string, cluster int, ts timestamp").parquet(f"{at.root}/pred"), at, "shop", "segments", f"{at.root}/state").awaitTermination()
    return at.read("shop", "segments").select("user_id", "site", F.col("cluster").cast("long").alias("cluster"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12'")
def o06_replay(spark, sf_dir):
    """The window of a failed run, replayed twice, is stored once."""
    at, ev = house(spark), table(spark, sf_dir, "events").select("event_id", "ts")
    span = lambda a, b: (F.col("ts") >= F.lit(a).cast(ev.schema["ts"].dataType)) & (F.col("ts") <= F.lit(b).cast(ev.schema["ts"].dataType))
    at.log_failed(ev.where(span("2024-01-10", "2024-01-12")), "views")
    at.log_failed(ev.where(span("2024-01-20", "2024-01-21")), "other")
    for _ in range(2):
        O.replay(ev, at, "views", lambda df: at.append_once(df, "shop", "events", ["event_id"]))
    return at.read("shop", "events").select("event_id")


@query("""SELECT c_custkey, c_name, 'shop' AS dataset, 'customer' AS "table" FROM customer""")
def a01_landing_csv(spark, sf_dir):
    """Landed files are named by dataset, table and time."""
    at = house(spark)
    _customers(spark, sf_dir).select("c_custkey", "c_name", F.lit(1).alias("Unnamed: 0")).write.option("header", True).csv(f"{at.root}/out")
    files, folder = at._files(f"{at.root}/out")
    for k, f in enumerate(x.getPath() for x in files.listStatus(folder)):
        if f.getName().endswith(".csv"):
            files.mkdirs(at._files(f"{at.root}/landing")[1])
            files.rename(f, at._files(f"{at.root}/landing/shop__customer_{k}.csv")[1])
    return A.read_landing_csv(spark, f"{at.root}/landing", "c_custkey bigint, c_name string, `Unnamed: 0` int")


@query("SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_custkey % 2 = 0")
def n15_entities_upsert(spark, sf_dir):
    """N15 with B1, B3: touched entities merged, the others kept."""
    o = table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"))
    old = o.withColumn("last_updated_date", F.lit("2001-01-01").cast("date"))
    new = o.where("o_orderkey % 2 = 0").withColumn("price", F.col("price") + 1)
    return B.upsert(old, new, "o_custkey", ["o_custkey", "o_orderkey"], "2002-02-02").unionByName(B.delete_entities(old, new, "o_custkey")).select("o_custkey", "o_orderkey", "price")


@query(f"""WITH old AS ({OLD}), new AS ({NEW}), t AS (SELECT * FROM old WHERE o_custkey IN (SELECT o_custkey FROM new)), u AS (SELECT o_custkey, o_orderkey, coalesce(n.status, t.status) AS status, coalesce(n.price, t.price) AS price,
 CASE WHEN coalesce(n.status, t.status) IS NOT DISTINCT FROM t.status AND coalesce(n.price, t.price) IS NOT DISTINCT FROM t.price THEN t.last_updated_date ELSE DATE '2002-02-02' END AS d FROM t FULL JOIN new n USING (o_custkey, o_orderkey))
SELECT o_custkey, o_orderkey, status, price, CAST(d AS VARCHAR) AS last_updated_date FROM u UNION ALL SELECT o_custkey, o_orderkey, status, price, CAST(last_updated_date AS VARCHAR) FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)""")
def b01_upsert_in_place(spark, sf_dir):
    """B1, B2 over a table in buckets of customers: all its rows after an upsert."""
    old, new = _states(spark, sf_dir)
    at = EntityTable(house(spark), "shop", "orders", ("o_custkey",), 16)
    at.create(old)
    at.upsert(new, ["o_custkey", "o_orderkey"], "2002-02-02")
    return at.read().withColumn("last_updated_date", F.col("last_updated_date").cast("string"))


@query(f"WITH old AS ({OLD}), new AS ({NEW}) SELECT o_orderkey, status, price FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)")
def b03_delete_in_place(spark, sf_dir):
    """B3 over a table in buckets of customers."""
    old, new = _states(spark, sf_dir)
    at = EntityTable(house(spark), "shop", "orders", ("o_custkey",), 16)
    at.create(old)
    at.delete(new)
    return at.read().select("o_orderkey", "status", "price")
