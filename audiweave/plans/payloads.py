"""Queries over nested payloads, which are built from flat tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.operators import nested as D
from audiweave.plans.inputs import table
from audiweave.plans.registry import query


def _orders(spark, sf):
    """A document per customer with its orders and one nested struct."""
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("deals"), F.max("o_orderpriority").alias("p"))
    return o.withColumn("deals", F.when(F.col("o_custkey") % 5 != 0, F.col("deals")))


def _answers(spark, sf):
    """A response per conversation: map of question id to an answer with options and sub-questions."""
    c = table(spark, sf, "conversations")
    option = F.struct(F.concat(F.lit("o"), F.col("turn").cast("string")).alias("id"), F.concat(F.lit("opt "), "text").alias("answer"))
    options = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("a"), option, F.lit("b"), option))
    sub = F.struct(F.col("role").alias("question"), F.col("text").alias("answer"))
    subs = F.when(F.col("turn") % 3 == 0, F.create_map(F.lit("1"), sub, F.lit("x"), sub, F.lit("2"), F.when(F.col("turn") == 3, sub)))
    one = F.struct(F.concat(F.lit("<b>"), "role", F.lit("</b>")).alias("question"), F.concat(F.lit("q-"), F.col("turn").cast("string")).alias("answer_id"), F.col("text").alias("answer"), options.alias("options"), subs.alias("subquestions"))
    return c.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("turn").cast("string"), one))).alias("survey"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 5 <> 0")
def d01_explode_records(spark, sf_dir):
    return D.explode_records(_orders(spark, sf_dir), "deals", ["o_custkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey % 5 <> 0")
def d02_explode_series(spark, sf_dir):
    return D.explode_series(_orders(spark, sf_dir), "deals")


@query("SELECT o_custkey, o_orderkey AS deal_o_orderkey, o_totalprice AS deal_o_totalprice FROM orders WHERE o_custkey % 5 <> 0")
def d03_child_table(spark, sf_dir):
    return D.child_table(_orders(spark, sf_dir), "o_custkey", "deals", "deal_")


@query("SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS name, 'deals' AS child FROM orders UNION ALL SELECT o_custkey, o_orderpriority, 'news' FROM orders")
def d04_child_tables(spark, sf_dir):
    named = lambda c: F.collect_list(F.struct(F.col(c).cast("string").alias("name")))
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(named("o_orderkey").alias("deals"), named("o_orderpriority").alias("news"))
    parts = D.child_tables(lists, "o_custkey", ["deals", "news"])
    return parts["deals"].withColumn("child", F.lit("deals")).union(parts["news"].withColumn("child", F.lit("news")))


@query("SELECT conv_id, CAST(turn AS VARCHAR) AS question_key, 'q-' || CAST(turn AS VARCHAR) AS answer_id, text AS answer FROM conversations")
def d05_answers(spark, sf_dir):
    return D.answers(_answers(spark, sf_dir), "survey", ["conv_id"]).select("conv_id", "question_key", "answer_id", "answer")


@query("""SELECT conv_id, 'o' || CAST(turn AS VARCHAR) AS answer_id, 'opt ' || text AS answer FROM conversations, (SELECT unnest([1, 2])) WHERE turn % 2 = 0
UNION ALL SELECT conv_id, 'q-' || CAST(turn AS VARCHAR), text FROM conversations WHERE turn % 2 = 1""")
def d06_unpack_options(spark, sf_dir):
    return D.unpack_options(D.answers(_answers(spark, sf_dir), "survey", ["conv_id"])).select("conv_id", "answer_id", "answer")


@query("""SELECT conv_id, CAST(turn AS VARCHAR) AS question_key, k AS sub_key, role AS sub_question, text AS sub_answer FROM conversations, (SELECT unnest(['1', '2']) AS k) WHERE turn % 3 = 0 AND (k = '1' OR turn = 3)""")
def d07_unpack_subquestions(spark, sf_dir):
    """Sub-questions of the answers of every third turn, one row each."""
    out = D.unpack_subquestions(D.answers(_answers(spark, sf_dir), "survey", ["conv_id"]))
    return out.select("conv_id", "question_key", "sub_key", "sub_question", "sub_answer")


@query("""SELECT conv_id, turn, turn * 10 + 1 AS option_id, text AS answer, CAST(NULL AS VARCHAR) AS note FROM conversations WHERE turn % 2 = 0
UNION ALL SELECT conv_id, turn, turn * 10 + 2, role, 'second' FROM conversations WHERE turn % 4 = 0""")
def d08_unpack_textboxes(spark, sf_dir):
    """Columns named by digits; the second box has a field that the first lacks."""
    c, turn = table(spark, sf_dir, "conversations"), F.col("turn")
    first = F.struct((turn * 10 + 1).alias("id"), F.col("text").alias("answer"))
    second = F.struct((turn * 10 + 2).alias("id"), F.col("role").alias("answer"), F.lit("second").alias("note"))
    wide = c.select("conv_id", "turn", F.when(turn % 2 != 0, "TABLE").alias("type"), first.alias("1"), F.when(turn % 4 == 0, second).alias("2"))
    return D.unpack_textboxes(wide, ["conv_id", "turn"])


@query("SELECT conv_id, role AS question, turn AS answer_id, text AS answer FROM conversations WHERE turn % 3 <> 0")
def d09_simple_answers(spark, sf_dir):
    return D.simple_answers(D.answers(_answers(spark, sf_dir), "survey", ["conv_id"])).select("conv_id", "question", "answer_id", "answer")


@query("SELECT event_type AS question, site AS label, n FROM (SELECT event_type, CAST(user_id % 3 AS VARCHAR) AS site, count(*) AS n FROM events GROUP BY 1, 2)")
def d10_breakdown(spark, sf_dir):
    ev = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 3).cast("string").alias("label")).agg(F.count("*").alias("n"))
    return D.breakdown(ev.groupBy(F.col("event_type").alias("question")).agg(F.collect_list(F.struct("label", "n")).alias("breakdown")))


@query("SELECT n_regionkey, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS ids, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) AS keys FROM nation GROUP BY 1")
def d11_subquestion_ids(spark, sf_dir):
    n = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_nationkey")).alias("l"), F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), F.col("n_name")))).alias("m"))
    return n.select("n_regionkey", D.subquestion_ids(F.col("l"), n.schema["l"].dataType).alias("ids"), D.subquestion_ids(F.col("m"), n.schema["m"].dataType).alias("keys"))


@query("""SELECT user_id, event_id AS id, event_type AS title FROM events WHERE user_id % 3 <> 0 UNION ALL SELECT user_id, min(event_id), min_by(event_type, event_id) FROM events WHERE user_id % 6 = 0 GROUP BY 1 UNION ALL SELECT DISTINCT user_id, CAST(NULL AS BIGINT), NULL FROM events WHERE user_id % 6 = 3""")
def d12_unnest_views(spark, sf_dir):
    v = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title"))
    ev = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(v).alias("one"), F.collect_list(v).alias("all"))
    ev = ev.select("user_id", F.when(F.col("user_id") % 6 == 0, F.col("one")).alias("one"), F.when(F.col("user_id") % 3 != 0, F.col("all")).alias("all"))
    return D.unnest_views(ev, "one", "all")


@query("SELECT event_id, 'Job Title' AS name, event_type AS value FROM events WHERE event_type <> 'error'")
def d13_form_fields(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", "a Test").otherwise(F.col("event_type"))
    forms = ev.select("event_id", F.array(F.struct(F.lit("Job Title").alias("name"), value.alias("value")), F.struct(F.lit("City").alias("name"), value.alias("value"))).alias("fields"))
    return D.form_fields(forms, "fields", "%JOB%")


@query("SELECT n_nationkey, n_name AS name, n_regionkey AS region FROM nation")
def d14_parse_pseudo_json(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.format_string("[{'name': '%s', 'region': %d}]", "n_name", "n_regionkey").alias("payload"))
    return D.parse_pseudo_json(n, "payload", "name string, region int")


@query("SELECT c_custkey AS id, c_name AS who_name, c_acctbal AS who_money_balance, 1 AS n_tags FROM customer")
def d15_flatten(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    nested = c.select(F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_acctbal").alias("balance")).alias("money")).alias("who"), F.create_map(F.lit("a"), F.lit(1), F.lit(""), F.lit(2)).alias("tags"))
    return D.flatten(nested).select("id", "who_name", "who_money_balance", F.size("tags").alias("n_tags"))


@query("""SELECT o_custkey, min(o_orderstatus) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT", coalesce(min(o_orderstatus) FILTER (o_orderpriority = '5-LOW'), 'none') AS country FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH') GROUP BY 1""")
def d16_contact_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderpriority in ('1-URGENT', '5-LOW', '2-HIGH')").withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "country").otherwise(F.col("o_orderpriority")))
    return D.contact_rows(o, "o_custkey", "o_orderpriority", "o_orderstatus", ["1-URGENT", "country"], F.lit("none"))


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct([99] || coalesce(list(k) FILTER (k IS NOT NULL), []))), ',') AS ids FROM (SELECT p_partkey, CASE WHEN contains(lower(p_name), w) THEN k END AS k FROM part, (SELECT unnest([1, 2, 3]) AS k, unnest(['red', 'blue', 'widget']) AS w)) GROUP BY 1""")
def d17_subscription_ids(spark, sf_dir):
    rules = spark.createDataFrame([(1, "Red"), (2, "blue"), (3, "widget")], "list_id int, pattern string")
    return D.subscription_ids(table(spark, sf_dir, "part"), rules, "p_partkey", "p_name", [99]).select("p_partkey", F.array_join("list_ids", ",").alias("ids"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS prospect_id, CASE WHEN c_custkey % 3 = 0 THEN 'update' ELSE 'create' END AS action FROM customer")
def d18_plan_contacts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    known = c.where("c_custkey % 3 = 0").select(F.upper("c_name").alias("email"), F.col("c_custkey").alias("prospect_id"))
    return D.plan_contacts(c.select("c_custkey", F.concat(F.lit(" "), "c_name").alias("email")), known, "email", "prospect_id").select("c_custkey", "prospect_id", "action")
