"""Queries that clean columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.plans.inputs import VIEWS_SQL, table, views
from audiweave.plans.registry import query

V = f"WITH v AS ({VIEWS_SQL})"


@query("SELECT o_orderkey AS order_key, o_totalprice AS _2_total, o_orderstatus AS state_now FROM orders")
def c01_clean_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(" Order-Key "), F.col("o_totalprice").alias("2 Total"), F.col("o_orderstatus").alias("State/now!"))
    return C.clean_columns(o)


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def c02_drop_personal(spark, sf_dir):
    return C.drop_personal(table(spark, sf_dir, "customer"))


@query("SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders")
def c03_coerce_numeric(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderstatus").alias("status"))
    return C.coerce_numeric(o, ["price", "status"])


@query("SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(epoch_us(date_trunc('second', ts)) AS BIGINT) END AS us FROM events")
def c04_parse_utc(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("t", F.when(F.col("event_id") % 3 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")))
    return ev.select("event_id", F.unix_micros(C.parse_utc(F.col("t"), "yyyy-MM-dd'T'HH:mm:ss")).alias("us"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS p FROM orders")
def c05_null_sentinels(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.null_sentinels(F.when(F.col("o_orderkey") % 4 == 0, "NA").otherwise(F.col("o_orderpriority"))).alias("p"))


@query("SELECT l_orderkey, l_linenumber, round(l_discount, 6) AS open_rate FROM lineitem")
def c06_pct_to_ratio(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat((F.col("l_discount") * 100).cast("string"), F.lit("%")).alias("open_rate"))
    return C.pct_columns_to_ratio(li).withColumn("open_rate", F.round("open_rate", 6))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done FROM orders")
def c07_to_bool(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "false").otherwise("maybe")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.to_bool(s).alias("done"))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders")
def c08_strip_thousands(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", C.strip_thousands(F.format_number(F.round("o_totalprice", 2), 2)).alias("price"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS FLOAT) END AS size FROM part")
def c09_blank_to_null(spark, sf_dir):
    s = F.when(F.col("p_size") % 3 > 0, F.col("p_size").cast("string")).otherwise(F.when(F.col("p_size") % 2 == 0, " ").otherwise("None"))
    return table(spark, sf_dir, "part").select("p_partkey", C.blank_to_null(s).alias("size"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\r]+', ' ', 'g')) AS text FROM pages""")
def c10_html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.html_to_text(F.col("html")).alias("text"))


@query("SELECT p_partkey, p_name FROM part")
def c11_strip_nul(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.strip_nul(F.replace("p_name", F.lit(" "), F.lit("\0"))).alias("p_name"))


@query("SELECT p_partkey, CAST(coalesce(nullif(regexp_replace(p_brand, '[^0-9]', '', 'g'), ''), '0') AS BIGINT) AS id FROM part")
def c12_digits_id(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.digits_id(F.col("p_brand")).alias("id"))


@query("SELECT p_partkey, p_name FROM part WHERE NOT p_name LIKE 'red%' AND NOT p_name LIKE 'blue%'")
def c13_drop_prefixed(spark, sf_dir):
    return C.drop_prefixed(table(spark, sf_dir, "part"), "p_name", ("red", "blue")).select("p_partkey", "p_name")


@query("SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm FROM pages")
def c14_url_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.url_param(F.col("url"), "page").alias("page"), C.url_param(F.col("url"), "utm_source").alias("utm"))


@query("SELECT CAST(n_nationkey AS INTEGER) AS code, n_name AS title FROM nation WHERE n_nationkey > 0")
def c15_code_table(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") == 0, "all").otherwise(F.col("n_nationkey").cast("string")).alias("code"), F.concat(F.lit("("), "n_name", F.lit(")")).alias("title"))
    return C.code_table(n, "code", "title")


@query("SELECT page_id, CASE split_part(url, '/', 3) WHEN 'www.tionsh.example.net' THEN 'mapped' ELSE regexp_replace(split_part(url, '/', 3), '^www\\.', '') END AS site FROM pages")
def c16_fold_site(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.fold_site(F.split_part("url", F.lit("/"), F.lit(3)), {"www.tionsh.example.net": "mapped"}).alias("site"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'Unknown' ELSE p_name END AS name, CASE WHEN p_partkey % 4 = 0 THEN 'Unknown' ELSE replace(p_type, ' ', ',') END AS tags FROM part")
def c19_or_unknown(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("name"), F.when(F.col("p_partkey") % 4 != 0, F.split("p_type", " ")).alias("tags"))
    return C.or_unknown(p, ["name", "tags"]).withColumn("tags", F.array_join("tags", ","))


@query("SELECT p_partkey, regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', '_', 'g') AS slug FROM part")
def c20_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.slug(F.concat_ws(" ", "p_brand", "p_name")).alias("slug"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'm' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer")
def c21_coalesce_id(spark, sf_dir):
    own = F.when(F.col("c_custkey") % 3 == 0, "0").otherwise(F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", C.coalesce_id(own, F.concat(F.lit("m"), F.col("c_custkey").cast("string"))).alias("id"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'Share' ELSE 'Trade' END AS short, CASE n_nationkey % 3 WHEN 0 THEN '' ELSE n_name END AS kind FROM nation")
def c27_split_indicator(spark, sf_dir):
    n = F.col("n_nationkey") % 3
    name = F.when(n == 0, F.col("n_name")).when(n == 1, F.concat(F.lit("Share: "), "n_name")).otherwise(F.concat(F.lit("Trade in "), "n_name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", C.split_indicator(name).alias("s")).select("n_nationkey", "s.short", "s.kind")


@query("""WITH x AS (SELECT o_orderkey, CAST(o_orderkey * 12345 AS DOUBLE) AS v FROM orders) SELECT o_orderkey, CASE WHEN v < 1000000 THEN format('{:,}', CAST(v AS BIGINT)) WHEN v < 1000000000 THEN format('{:,.1f}', v / 1000000) || ' million' ELSE format('{:,.1f}', v / 1000000000) || 'bn' END AS t FROM x""")
def c28_big_number(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", C.big_number((F.col("o_orderkey") * 12345).cast("double")).alias("t"))


@query("""SELECT p_size, CASE WHEN p_size BETWEEN 1 AND 10 THEN ['first', 'second', 'third', 'fourth', 'fifth', 'sixth', 'seventh', 'eighth', 'ninth', 'tenth'][p_size] ELSE CAST(p_size AS VARCHAR) || CASE WHEN p_size % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END END AS t FROM part""")
def c29_ordinal(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_size", C.ordinal(F.col("p_size")).alias("t"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand || '%' WHEN 1 THEN '$' || p_brand ELSE p_brand END AS t FROM part")
def c30_unit_text(spark, sf_dir):
    name = F.when(F.col("p_size") % 3 == 0, "Growth Rate").when(F.col("p_size") % 3 == 1, "GDP in USD").otherwise("Places")
    return table(spark, sf_dir, "part").select("p_partkey", C.unit_text(F.col("p_brand"), name).alias("t"))


@query("SELECT p_partkey, replace(p_type, ' ', ', ') AS t FROM part")
def c31_join_list(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.join_list(F.split("p_type", " ")).alias("t"))


@query("SELECT o_orderkey AS id, o_custkey AS owner, o_totalprice FROM orders")
def c33_campaign_list(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "id", "o_custkey": "owner"}).select("id", "owner", "o_totalprice")


@query("SELECT c_custkey, lower(c_name) || '@x.org' AS value FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 10 <> 0")
def c34_form_emails(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    mail = F.concat(F.lit(" "), "c_name", F.lit("@X.org"))
    forms = c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, mail).otherwise("none").alias("value"))
    blocked = c.where("c_custkey % 10 = 0").select(F.lower(F.trim(mail)).alias("value"))
    return C.form_emails(forms, "value", blocked).select("c_custkey", "value")


@query("SELECT p_partkey, CASE WHEN p_size < 25 THEN 'This was ' ELSE 'This is ' END || p_name || ' at $5m. It rose 10–12.' AS t FROM part")
def c35_polish(spark, sf_dir):
    raw = F.concat(F.lit("this is "), "p_name", F.lit(" at $5 million. it rose 10-12."))
    return table(spark, sf_dir, "part").select("p_partkey", C.polish(raw, F.col("p_size"), F.lit(25)).alias("t"))


@query("SELECT page_id, coalesce(nullif(string_split(url, '/')[4], ''), 'none') AS section FROM pages")
def c36_site_section(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.site_section(F.col("url")).alias("section"))


@query("SELECT s_suppkey, 'smith and sons ' || CAST(s_suppkey AS VARCHAR) AS name FROM supplier")
def l01_clean_company(spark, sf_dir):
    raw = F.concat(F.lit("Smith & Sons, Group "), F.col("s_suppkey").cast("string"), F.element_at(F.array(*map(F.lit, (" Ltd.", ", Inc", " GmbH", "!"))), (F.col("s_suppkey") % 4 + 1).cast("int")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", C.clean_company(raw).alias("name"))


RAW_TITLE = """CASE p_partkey % 6 WHEN 0 THEN 'C++/' || p_name WHEN 1 THEN ' R & D. ' || upper(p_name) || ' ' WHEN 2 THEN 'Vice-' || p_name || ', No. 1' WHEN 3 THEN 'X.'
 WHEN 4 THEN 'Professional and technical staff (e.g. lawyer, engineer, architect)' ELSE p_name || '\t' || p_type END"""


@query(f"""WITH r AS (SELECT p_partkey, {RAW_TITLE.replace(chr(92) + 't', chr(9))} AS raw FROM part), c AS (SELECT p_partkey, regexp_replace(regexp_replace(replace(replace(lower(raw), '.', ''), '-', ' '), '[^A-Za-z\\s]+', '', 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM r)
SELECT p_partkey, CASE WHEN t = 'professional and technical staff eg lawyer engineer architect' THEN 'professional' WHEN length(t) >= 2 THEN t END AS title FROM c""")
def l04_clean_title(spark, sf_dir):
    """Signs go without a space, single letters stay, a title of one letter is none, and a known one is mapped."""
    return table(spark, sf_dir, "part").select("p_partkey", C.clean_title(F.expr(RAW_TITLE)).alias("title"))


@query("SELECT p_partkey, regexp_matches(p_name, '\\bred\\b') OR regexp_matches('red', '\\b' || p_name || '\\b') AS found FROM part")
def l05_word_found(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", C.word_found(F.lit("red"), F.col("p_name")).alias("found"))
