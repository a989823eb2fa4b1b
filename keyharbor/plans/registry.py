"""Queries by name, and the same in DuckDB's SQL. Doubles are rounded on both sides, for sums depend on their order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import keyharbor as kh
from keyharbor.operators.query import Expr, col
from keyharbor.plans.mounts import event_log, event_series, hashes, keyed, millis, places, table
from keyharbor.sources import write
from keyharbor.sources.scratch import run_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def put(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return put


def rounded(name: str, alias: str | None = None, places: int = 4) -> F.Column:
    return F.round(name, places).alias(alias or name)


# Aggregation


@query("agg_min_slice", """
    SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS avg_price FROM orders
    WHERE o_totalprice > 100000 AND o_orderstatus = 'F' GROUP BY 1""")  # fmt: skip
def agg_min_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kh.aggregate(keyed(table(spark, sf_dir, "orders"), "order", "o_orderkey"), (col("o_totalprice") > 100000) & (col("o_orderstatus") == "F"), group_by=["@o_orderpriority"], reduce=[("COUNT", [], "n"), ("AVG", ["@o_totalprice"], "avg_price")], sort_by=[("@n", False)])
    return out.select("o_orderpriority", "n", rounded("avg_price"))


def _reducer(name: str, fn: str, args: list, sql: str, shape: str = "num") -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = kh.aggregate(table(spark, sf_dir, "lineitem"), group_by=["l_returnflag", "l_linestatus"], reduce=[(fn, args, "x")])
        return out.withColumn("x", F.round("x", 4)) if shape == "num" else out.withColumn("x", F.array_join("x", ",")) if shape == "list" else out

    query(f"agg_{name}", f"SELECT l_returnflag, l_linestatus, {sql} AS x FROM lineitem GROUP BY ALL")(run)


_reducer("count", "COUNT", [], "count(*)", "as is")
_reducer("count_distinct", "COUNT_DISTINCT", ["@l_partkey"], "count(DISTINCT l_partkey)", "as is")
_reducer("sum", "SUM", ["@l_quantity"], "round(sum(l_quantity), 4)")
_reducer("avg", "AVG", ["@l_discount"], "round(avg(l_discount), 4)")
_reducer("min", "MIN", ["@l_extendedprice"], "round(min(l_extendedprice), 4)")
_reducer("max", "MAX", ["@l_extendedprice"], "round(max(l_extendedprice), 4)")
_reducer("first_by", "FIRST_VALUE", ["@l_partkey", "BY", "@l_orderkey", "@l_linenumber"], "arg_min(l_partkey, (l_orderkey, l_linenumber))", "as is")
_reducer("tolist", "TOLIST", ["@l_linenumber"], "array_to_string(list_sort(list(DISTINCT l_linenumber)), ',')", "list")
_reducer("quantile", "QUANTILE", ["@l_extendedprice", 0.9], "round(quantile_cont(l_extendedprice, 0.9), 4)")
_reducer("stddev", "STDDEV", ["@l_quantity"], "round(stddev_samp(l_quantity), 4)")


@query("agg_global", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, count(DISTINCT o_custkey) AS customers FROM orders")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kh.aggregate(table(spark, sf_dir, "orders"), reduce=[("COUNT", [], "n"), ("SUM", ["@o_totalprice"], "total"), ("COUNT_DISTINCT", ["@o_custkey"], "customers")])
    return out.select("n", rounded("total", places=2), "customers")


@query("agg_count_distinctish", "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, true AS near FROM lineitem GROUP BY 1")
def agg_count_distinctish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near: the approximate count is within a fifth of the exact one (four of its standard errors)."""
    out = kh.aggregate(table(spark, sf_dir, "lineitem"), group_by=["l_returnflag"], reduce=[("COUNT_DISTINCTISH", ["@l_partkey"], "x"), ("COUNT_DISTINCT", ["@l_partkey"], "exact")])
    return out.select("l_returnflag", "exact", (F.abs(F.col("x") / F.col("exact") - 1) < 0.2).alias("near"))


@query("agg_apply", """
    SELECT l_returnflag, round(sum(l_extendedprice), 2) AS gross, round(avg(l_discount), 6) AS off, round(sum(l_extendedprice) * (1 - avg(l_discount)) / 1000, 2) AS net_k, upper('flag ' || l_returnflag) AS label
    FROM lineitem GROUP BY l_returnflag""")  # fmt: skip
def agg_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kh.aggregate(table(spark, sf_dir, "lineitem"), group_by=["@l_returnflag"], reduce=[("SUM", ["@l_extendedprice"], "gross"), ("AVG", ["@l_discount"], "off")], apply=[("@gross * (1 - @off) / 1000", "net_k"), ("upper(concat('flag ', @l_returnflag))", "label")])
    return out.select("l_returnflag", rounded("gross", places=2), rounded("off", places=6), rounded("net_k", places=2), "label")


@query("agg_having", "SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY 1 HAVING count(*) > 600 AND NOT sum(l_quantity) < 10")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kh.aggregate(table(spark, sf_dir, "lineitem"), group_by=["@l_suppkey"], reduce=[("COUNT", [], "n"), ("SUM", ["@l_quantity"], "q")], filter_expr="@n > 600 && !(@q < 10)")
    return out.select("l_suppkey", "n", rounded("q", places=2))


@query("agg_sort_limit", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10 OFFSET 5")
def agg_sort_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.aggregate(table(spark, sf_dir, "orders"), group_by=["@o_custkey"], reduce=[("COUNT", [], "n")], sort_by=[("@n", False), ("@o_custkey", True)], limit=10, offset=5)


@query("agg_json", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def agg_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "events"), "event", "event_id").select("_key", F.col("props").alias("doc"))
    return kh.aggregate_json(docs, schema={"k": int}, group_by=["@k"], reduce=[("COUNT", [], "n")])


# Scans


@query("scan_hashes_typed", "SELECT 'customer:' || c_custkey AS _key, c_custkey, c_name, c_acctbal FROM customer")
def scan_hashes_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_hashes(hashes(table(spark, sf_dir, "customer"), "customer", "c_custkey"), "customer:*", {"c_custkey": int, "c_name": str, "c_acctbal": float})


@query("scan_hashes_projection", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def scan_hashes_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kh.scan_hashes(hashes(table(spark, sf_dir, "customer"), "customer", "c_custkey"), "*", {"c_custkey": int, "c_mktsegment": str}, include_key=False)
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("scan_hashes_datetime", "SELECT 'order:' || o_orderkey AS _key, o_orderdate, CAST(o_orderdate AS DATE) AS day FROM orders")
def scan_hashes_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = hashes(table(spark, sf_dir, "orders"), "order", "o_orderkey").withColumn("day", F.substring("o_orderdate", 1, 10))
    return kh.scan_hashes(o, "order:*", {"o_orderdate": "datetime", "day": "date"})


@query("scan_hashes_index_ttl", "SELECT row_number() OVER (ORDER BY 'nation:' || n_nationkey) - 1 AS _index, 'nation:' || n_nationkey AS _key, CAST(CASE WHEN n_nationkey % 3 = 0 THEN -1 ELSE 60 + n_nationkey END AS BIGINT) AS _ttl, n_name FROM nation WHERE n_nationkey % 3 <> 1")
def scan_hashes_index_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("int")
    h = hashes(table(spark, sf_dir, "nation"), "nation", "n_nationkey").withColumn("_expire_at", F.when(k % 3 == 0, None).when(k % 3 == 1, 999.0).otherwise(1060.0 + k))
    return kh.scan_hashes(h, "*", {"n_name": str}, include_row_index=True, include_ttl=True, now=1000.0)


_LINES = "'line:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey"


def line_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as hashes: four numbers tell its rows apart, but for a few; those are alike in what is asked of them."""
    li = table(spark, sf_dir, "lineitem")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return li.select(F.concat_ws(":", F.lit("line"), *parts).alias("_key"), *(F.col(c).cast("string").alias(c) for c in li.columns))


@query("scan_row_index_lineitem", f"SELECT 5 + row_number() OVER (ORDER BY {_LINES}) - 1 AS _index, {_LINES} AS _key, l_orderkey FROM lineitem")
def scan_row_index_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_hashes(line_hashes(spark, sf_dir), "line:*", {"l_orderkey": int}, include_row_index=True, row_index_offset=5)


@query("scan_orders_typed", "SELECT 'order:' || o_orderkey AS _key, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")
def scan_orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = hashes(table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")), "order", "o_orderkey")
    return kh.scan_hashes(o, "order:*", {"o_custkey": int, "o_orderstatus": str, "o_totalprice": float, "o_orderdate": "date", "o_orderpriority": str})


@query("scan_glob_keys", "SELECT 'customer:' || c_custkey AS _key FROM customer WHERE 'customer:' || c_custkey GLOB 'customer:1?[2-5]*'")
def scan_glob_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_keys(keyed(table(spark, sf_dir, "customer"), "customer", "c_custkey"), "customer:1?[2-5]*")


@query("scan_json_props", "SELECT 'event:' || event_id AS _key, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "events"), "event", "event_id").select("_key", F.col("props").alias("doc"))
    return kh.scan_json(docs, "event:*", {"k": int})


@query("scan_strings_int", "SELECT 'nation:' || n_nationkey AS _key, CAST(n_regionkey AS BIGINT) AS value FROM nation")
def scan_strings_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = keyed(table(spark, sf_dir, "nation"), "nation", "n_nationkey").select("_key", F.col("n_regionkey").cast("string").alias("value"))
    return kh.scan_strings(n, "nation:*", value_type=int)


@query("scan_sets_members", "SELECT DISTINCT 'order:' || l_orderkey AS _key, CAST(l_suppkey AS VARCHAR) AS member FROM lineitem")
def scan_sets_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "lineitem"), "order", "l_orderkey").select("_key", F.col("l_suppkey").alias("member"))
    return kh.scan_sets(write.set_rows(rows), "order:*")


@query("scan_lists_position", "SELECT 'order:' || l_orderkey AS _key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS position, CAST(l_partkey AS VARCHAR) AS element FROM lineitem")
def scan_lists_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "lineitem"), "order", "l_orderkey").select("_key", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("at"), F.col("l_partkey").alias("element"))
    return kh.scan_lists(write.list_rows(rows, index_column="at"), "order:*", include_position=True)


@query("scan_zsets_rank", "SELECT 'nation:' || c_nationkey AS _key, 'customer:' || c_custkey AS member, c_acctbal AS score, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, 'customer:' || c_custkey) - 1 AS rank FROM customer")
def scan_zsets_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string")).alias("_key"), F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("member"), F.col("c_acctbal").alias("score"))
    return kh.scan_zsets(write.zset_rows(rows), "nation:*", include_rank=True)


_EVENTS = "(SELECT 'user:' || user_id AS _key, epoch_us(ts) // 1000 AS ms, event_id AS seq, event_type, value FROM events)"


@query("scan_streams_range", f"""
    SELECT _key, ms || '-' || seq AS _id, ms AS _ts, event_type FROM {_EVENTS}
    WHERE ms >= (SELECT min(epoch_us(ts)) // 1000 + 3600000 FROM events) AND ms <= (SELECT min(epoch_us(ts)) // 1000 + 36000000 FROM events)""")  # fmt: skip
def scan_streams_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    first = log.agg(F.min("ms")).first()[0]
    return kh.scan_streams(log, "user:*", fields=["event_type"], start_id=str(first + 3600000), end_id=str(first + 36000000))


@query("stream_count_per_key", f"SELECT _key, ms || '-' || seq AS _id, ms AS _ts, seq AS _seq, value FROM (SELECT *, row_number() OVER (PARTITION BY _key ORDER BY ms, seq) AS n FROM {_EVENTS}) WHERE n <= 3".replace(", value FROM (SELECT", ", event_type FROM (SELECT", 1))
def stream_count_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_streams(event_log(spark, sf_dir), "user:*", fields=["event_type"], include_sequence=True, count_per_stream=3)


@query("ts_range_raw", "SELECT 'ts:' || user_id AS _key, epoch_us(ts) // 1000 AS _ts, value FROM events WHERE epoch_us(ts) // 1000 >= 1704067200000")
def ts_range_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_timeseries(event_series(spark, sf_dir), "ts:*", start=1704067200000)


_TS_SQL = {
    "avg": "avg(value)", "sum": "sum(value)", "min": "min(value)", "max": "max(value)", "range": "max(value) - min(value)", "count": "CAST(count(value) AS DOUBLE)",
    "std.p": "stddev_pop(value)", "std.s": "stddev_samp(value)", "var.p": "var_pop(value)", "var.s": "var_samp(value)",
    "first": "arg_min(value, epoch_us(ts) // 1000)", "last": "arg_max(value, epoch_us(ts) // 1000)",
}


def _bucketed(name: str) -> None:
    tied = name in ("first", "last")  # of samples at one millisecond, the series keeps the greatest value

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        series = event_series(spark, sf_dir)
        series = series.groupBy("_key", "ts").agg(F.max("value").alias("value")) if tied else series
        return kh.scan_timeseries(series, "ts:*", aggregation=name, bucket_size_ms=3600000).select("_key", "_ts", rounded("value", places=6))

    source = "(SELECT user_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, max(value) AS value FROM events GROUP BY ALL)" if tied else "events"
    query(f"ts_bucket_{name.replace('.', '_')}", f"SELECT 'ts:' || user_id AS _key, epoch_us(ts) // 3600000000 * 3600000 AS _ts, round({_TS_SQL[name]}, 6) AS value FROM {source} GROUP BY ALL")(run)


for _name in _TS_SQL:
    _bucketed(_name)


@query("ts_count_per_series", "SELECT _key, _ts, value FROM (SELECT 'ts:' || user_id AS _key, epoch_us(ts) // 3600000000 * 3600000 AS _ts, round(sum(value), 4) AS value, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 3600000000) AS n FROM events GROUP BY user_id, epoch_us(ts) // 3600000000) WHERE n <= 2")
def ts_count_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_timeseries(event_series(spark, sf_dir), "ts:*", aggregation="sum", bucket_size_ms=3600000, count_per_series=2).select("_key", "_ts", rounded("value"))


@query("key_info", "SELECT 'nation:' || n_nationkey AS key, 'hash' AS key_type, CAST(-1 AS BIGINT) AS ttl FROM nation UNION ALL SELECT 'region:' || r_regionkey, 'string', -1 FROM region")
def key_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = keyed(table(spark, sf_dir, "region"), "region", "r_regionkey").select("_key", F.col("r_name").alias("value"))
    return kh.key_info({"hash": hashes(table(spark, sf_dir, "nation"), "nation", "n_nationkey"), "string": r}).select("key", "key_type", "ttl")


# Predicates


def _filtered(name: str, of: str, key: str, q: Expr, where: str, fields: dict | None = None, params: dict | None = None, made: dict[str, str] | None = None) -> None:
    """made: columns, in Spark SQL, that the table lacks."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, of).withColumns({c: F.expr(said) for c, said in (made or {}).items()})
        return kh.search(keyed(df, of, key), q, fields=fields, params=params or {}).select(key)

    query(f"pred_{name}", f"SELECT {key} FROM {of} WHERE {where}")(run)


_TAGS = {"c_mktsegment": kh.TagField("c_mktsegment"), "p_type": kh.TagField("p_type", separator=" "), "o_orderpriority": kh.TagField("o_orderpriority")}
_TOKENS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')"
_filtered("gt", "orders", "o_orderkey", col("o_totalprice") > 200000, "o_totalprice > 200000")
_filtered("gte", "orders", "o_orderkey", col("o_totalprice") >= 200000, "o_totalprice >= 200000")
_filtered("lt", "orders", "o_orderkey", col("o_totalprice") < 20000, "o_totalprice < 20000")
_filtered("lte", "orders", "o_orderkey", col("o_totalprice") <= 20000, "o_totalprice <= 20000")
_filtered("eq_num", "part", "p_partkey", col("p_size") == 10, "p_size = 10")
_filtered("eq_tag", "customer", "c_custkey", col("c_mktsegment") == "building", "lower(c_mktsegment) = 'building'", _TAGS)
_filtered("ne", "customer", "c_custkey", col("c_mktsegment") != "BUILDING", "c_mktsegment IS DISTINCT FROM 'BUILDING'")
_filtered("and", "orders", "o_orderkey", (col("o_totalprice") > 100000) & (col("o_orderstatus") == "F"), "o_totalprice > 100000 AND o_orderstatus = 'F'")
_filtered("or", "orders", "o_orderkey", (col("o_totalprice") > 300000) | (col("o_orderstatus") == "P"), "o_totalprice > 300000 OR o_orderstatus = 'P'")
_filtered("not", "orders", "o_orderkey", ~((col("o_orderstatus") == "F") | (col("o_totalprice") < 50000)), "NOT (o_orderstatus = 'F' OR o_totalprice < 50000)")
_filtered("between", "part", "p_partkey", col("p_size").is_between(5, 9), "p_size BETWEEN 5 AND 9")
_filtered("in", "orders", "o_orderkey", col("o_orderstatus").is_in(["F", "P"]), "o_orderstatus IN ('F', 'P')")
_filtered("in_empty", "orders", "o_orderkey", col("o_orderstatus").is_in([]), "false")
_filtered("text_term", "part", "p_partkey", col("p_name").contains("widget"), f"list_contains({_TOKENS.format('p_name')}, 'widget')")
_filtered("prefix", "part", "p_partkey", col("p_name").starts_with("co"), f"len(list_filter({_TOKENS.format('p_name')}, lambda t: starts_with(t, 'co'))) > 0")
_filtered("suffix", "part", "p_partkey", col("p_name").ends_with("et"), f"len(list_filter({_TOKENS.format('p_name')}, lambda t: ends_with(t, 'et'))) > 0")
_filtered("infix", "part", "p_partkey", col("p_name").contains_substring("idge"), f"len(list_filter({_TOKENS.format('p_name')}, lambda t: contains(t, 'idge'))) > 0")
_filtered("wildcard", "part", "p_partkey", col("p_name").matches("w*t"), f"len(list_filter({_TOKENS.format('p_name')}, lambda t: t GLOB 'w*t')) > 0")
_filtered("wildcard_exact", "part", "p_partkey", col("p_name").matches_exact("c* w?dget"), "p_name GLOB 'c* w?dget'")
_filtered("fuzzy", "part", "p_partkey", col("p_name").fuzzy("wadget", 1), f"len(list_filter({_TOKENS.format('p_name')}, lambda t: levenshtein(t, 'wadget') <= 1)) > 0")
_filtered("phrase", "documents", "doc_id", col("text").phrase("of", "the"), f"contains(' ' || array_to_string({_TOKENS.format('text')}, ' ') || ' ', ' of the ')")
_filtered("phrase_slop", "documents", "doc_id", col("text").phrase("of", "the", slop=2, inorder=True), f"regexp_matches(' ' || array_to_string({_TOKENS.format('text')}, ' ') || ' ', ' of ([^ ]+ ){{0,2}}the ')")
_filtered("tag", "part", "p_partkey", col("p_type").has_tag("economy"), "list_contains(string_split(lower(p_type), ' '), 'economy')", _TAGS)
_filtered("tag_any", "part", "p_partkey", col("p_type").has_any_tag(["SMALL", "promo"]), "list_has_any(string_split(lower(p_type), ' '), ['small', 'promo'])", _TAGS)
_filtered("multi_field", "part", "p_partkey", kh.cols("p_name", "p_brand").contains("red"), f"list_contains({_TOKENS.format('p_name')}, 'red') OR list_contains({_TOKENS.format('p_brand')}, 'red')")
_filtered("multi_field_prefix", "part", "p_partkey", kh.cols("p_name", "p_type").starts_with("sm"), f"len(list_filter(list_concat({_TOKENS.format('p_name')}, {_TOKENS.format('p_type')}), lambda t: starts_with(t, 'sm'))) > 0")
_filtered("null", "documents", "doc_id", col("other").is_null(), "lang = 'en'", made={"other": "nullif(lang, 'en')"})
_filtered("not_null", "documents", "doc_id", col("other").is_not_null(), "lang <> 'en'", made={"other": "nullif(lang, 'en')"})
_filtered("boost_optional", "part", "p_partkey", (col("p_name").contains("widget").boost(2.0)) & col("p_name").contains("cold").optional(), f"list_contains({_TOKENS.format('p_name')}, 'widget')")
_filtered("raw_query", "part", "p_partkey", kh.raw("p_size % 5 = 0 AND p_retailprice > 900"), "p_size % 5 = 0 AND p_retailprice > 900")
_filtered("regex", "documents", "doc_id", col("text").matches_regex("[0-9]{3}-[0-9]{4}"), "regexp_matches(text, '[0-9]{3}-[0-9]{4}')")
_filtered("icontains", "documents", "doc_id", col("text").icontains("LICENSED under"), "contains(lower(text), 'licensed under')")
_filtered("iequals", "customer", "c_custkey", col("c_mktsegment").iequals("Building"), "lower(c_mktsegment) = 'building'")
_filtered("contains_any", "documents", "doc_id", col("text").contains_any(["idiot", "Licensed", "@"]), "contains(text, 'idiot') OR contains(text, 'Licensed') OR contains(text, '@')")
_filtered("similar", "part", "p_partkey", col("p_name").similar_to("cold widget", 0.7), "1 - levenshtein(p_name, 'cold widget') / greatest(length(p_name), 11) >= 0.7")
_filtered("date_cmp", "orders", "o_orderkey", (col("o_orderdate").as_date() >= "1995-01-01") & (col("o_orderdate").as_datetime() < "1996-06-30T12:00:00"), "CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AND o_orderdate < TIMESTAMP '1996-06-30 12:00:00'")
_filtered("date_part", "orders", "o_orderkey", col("o_orderdate").as_date().month().is_in([1, 2]) & (col("o_orderdate").as_date().year() >= 1996), "month(o_orderdate) IN (1, 2) AND year(o_orderdate) >= 1996")
_filtered("weekday", "orders", "o_orderkey", col("o_orderdate").as_datetime().weekday() == 0, "isodow(o_orderdate) = 1")
_filtered("hour_minute", "events", "event_id", (col("ts").as_datetime().hour() < 6) & (col("ts").as_datetime().minute() > 30), "hour(ts) < 6 AND minute(ts) > 30")
_filtered("array_contains", "part", "p_partkey", col("names").array_contains("red"), "list_contains(string_split(p_name, ' '), 'red')", made={"names": "split(p_name, ' ')"})
_filtered("array_len", "documents", "doc_id", col("said").array_len() > 100, "len(string_split(text, ' ')) > 100", made={"said": "split(text, ' ')"})
_filtered("json_path", "events", "event_id", col("props").json_path("$.k") > 50, "CAST(json_extract_string(props, '$.k') AS DOUBLE) > 50")


# Search


@query("search_sorted", "SELECT 'order:' || o_orderkey AS _key, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC, 'order:' || o_orderkey LIMIT 20 OFFSET 10")
def search_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.search_hashes(hashes(table(spark, sf_dir, "orders"), "order", "o_orderkey"), col("o_totalprice") > 100000, {"o_orderkey": int, "o_totalprice": float}, sort_by="o_totalprice", sort_ascending=False, offset=10, n_rows=20)


@query("search_json", "SELECT 'event:' || event_id AS _key, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) BETWEEN 10 AND 12")
def search_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = keyed(table(spark, sf_dir, "events"), "event", "event_id").select("_key", F.col("props").alias("doc"))
    return kh.search_json(docs, col("k").is_between(10, 12), {"k": int})


_BM25_TERMS = ("widget", "cold")


@query("search_bm25", f"""
    WITH t AS (SELECT p_partkey, {_TOKENS.format('p_name')} AS tok FROM part), s AS (
        SELECT count(*) AS n, avg(len(tok)) AS al, {', '.join(f"sum(CAST(list_contains(tok, '{w}') AS INT)) AS d{k}" for k, w in enumerate(_BM25_TERMS))} FROM t
    )
    SELECT p_partkey, round({' + '.join(f"ln(1 + (n - d{k} + 0.5) / (d{k} + 0.5)) * len(list_filter(tok, lambda x: x = '{w}')) * 2.2 / (len(list_filter(tok, lambda x: x = '{w}')) + 1.2 * (0.25 + 0.75 * len(tok) / al))" for k, w in enumerate(_BM25_TERMS))}, 4) AS score
    FROM t, s WHERE list_contains(tok, 'widget') OR list_contains(tok, 'cold')""")  # fmt: skip
def search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kh.search(keyed(table(spark, sf_dir, "part"), "part", "p_partkey"), col("p_name").contains("widget") | col("p_name").contains("cold"), include_score=True, score_column_name="score")
    return found.select("p_partkey", rounded("score"))


@query("search_ttl", "SELECT row_number() OVER (ORDER BY n_name) - 1 AS _index, 'nation:' || n_nationkey AS k, CAST(CASE WHEN n_nationkey % 3 = 0 THEN -1 ELSE 60 + n_nationkey END AS BIGINT) AS _ttl, n_name, CAST(NULL AS BIGINT) AS missing FROM nation WHERE n_nationkey % 3 <> 1 AND n_nationkey > 3")
def search_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("int")
    h = hashes(table(spark, sf_dir, "nation"), "nation", "n_nationkey").withColumn("_expire_at", F.when(k % 3 == 0, None).when(k % 3 == 1, 999.0).otherwise(1060.0 + k))
    schema = {"n_name": str, "n_nationkey": int, "missing": int}
    return kh.search_hashes(h, col("n_nationkey") > 3, schema, sort_by="n_name", include_row_index=True, include_ttl=True, key_column_name="k", projection=["n_name", "missing"], now=1000.0)


@query("search_slop_default", f"SELECT doc_id FROM documents WHERE regexp_matches(' ' || array_to_string({_TOKENS.format('text')}, ' ') || ' ', ' of ([^ ]+ ){{0,2}}the ')")
def search_slop_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.search(keyed(table(spark, sf_dir, "documents"), "doc", "doc_id"), col("text").phrase("of", "the"), options=kh.SearchOptions().with_slop(2).with_in_order()).select("doc_id")


def _bm25_sql(matches: str) -> str:
    return f"""
    WITH t AS (SELECT p_partkey, {_TOKENS.format('p_name')} AS tok FROM part), c AS (SELECT *, len(list_filter(tok, lambda x: {matches})) AS tf FROM t), s AS (
        SELECT count(*) AS n, avg(len(tok)) AS al, count(*) FILTER (WHERE tf > 0) AS d FROM c
    )
    SELECT p_partkey, round(ln(1 + (n - d + 0.5) / (d + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tok) / al)), 4) AS score FROM c, s WHERE tf > 0"""


def _scored(name: str, q: Expr, matches: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kh.search(keyed(table(spark, sf_dir, "part"), "part", "p_partkey"), q, include_score=True, score_column_name="score").select("p_partkey", rounded("score"))

    query(f"search_score_{name}", _bm25_sql(matches))(run)


_scored("prefix", col("p_name").starts_with("wi"), "starts_with(x, 'wi')")
_scored("suffix", col("p_name").ends_with("et"), "ends_with(x, 'et')")
_scored("infix", col("p_name").contains_substring("ol"), "contains(x, 'ol')")
_scored("fuzzy", col("p_name").fuzzy("wadget", 1), "levenshtein(x, 'wadget') <= 1")


@query("search_in_keys", "SELECT p_partkey FROM part WHERE p_partkey IN (1, 2, 3, 5, 8, 13) AND p_size < 40")
def search_in_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.search(keyed(table(spark, sf_dir, "part"), "part", "p_partkey"), col("p_size") < 40, in_keys=[f"part:{k}" for k in (1, 2, 3, 5, 8, 13)]).select("p_partkey")


@query("search_highlight", "SELECT p_partkey, regexp_replace(p_name, '(?i)\\b(widget)\\b', '<em>\\1</em>', 'g') AS p_name FROM part WHERE list_contains(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}]+'), 'widget')")
def search_highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.search(keyed(table(spark, sf_dir, "part"), "part", "p_partkey"), col("p_name").contains("widget"), highlight=kh.HighlightOptions(open_tag="<em>", close_tag="</em>")).select("p_partkey", "p_name")


@query("search_summarize", """
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents), h AS (
        SELECT doc_id, w, list_position(list_transform(w, lambda x: regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g') = 'that'), true) - 1 AS i FROM w
    )
    SELECT doc_id, array_to_string(w[greatest(i - 2, 0) + 1 : greatest(i - 2, 0) + 8], ' ') AS text FROM h WHERE i >= 0""")  # fmt: skip
def search_summarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = keyed(table(spark, sf_dir, "documents"), "doc", "doc_id")
    q = kh.raw("exists(filter(split(text, '\\\\s+'), w -> w <> ''), w -> regexp_replace(lower(w), '[^\\\\p{L}\\\\p{N}]+', '') = 'that')")
    found = kh.search(d, q & col("text").contains("that").optional(), no_stopwords=True, summarize=kh.SummarizeOptions(frags=1, len=8))
    return found.select("doc_id", "text")


def _nearest(name: str, metric: str, sql: str, extra: Expr | None = None, where: str = "true") -> None:
    target = [((k * 7) % 11 - 5) / 5.0 for k in range(64)]
    said = f"[{', '.join(map(str, target))}]::DOUBLE[64]"
    fields = {"embedding": kh.VectorField("embedding", dim=64, distance_metric=metric)}

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        q = col("embedding").knn(10)
        found = kh.search(keyed(table(spark, sf_dir, "embeddings"), "vec", "vec_id"), extra & q if extra is not None else q, fields=fields, params={"query_vec": target})
        return found.select("vec_id", rounded("_distance", "d"))

    query(name, f"SELECT vec_id, round(d, 4) AS d FROM (SELECT vec_id, {sql.format(v='embedding::DOUBLE[64]', t=said)} AS d, 'vec:' || vec_id AS k FROM embeddings WHERE {where}) ORDER BY d, k LIMIT 10".replace("round(d, 4)", "round(d, 4)"))(run)


_nearest("knn_cosine", "COSINE", "1 - array_cosine_similarity({v}, {t})")
_nearest("knn_l2", "L2", "array_distance({v}, {t}) ^ 2")
_nearest("knn_ip", "IP", "1 - array_inner_product({v}, {t})")
_nearest("knn_filtered", "COSINE", "1 - array_cosine_similarity({v}, {t})", col("label") == 3, "label = 3")


@query("vector_range", "SELECT a.vec_id FROM embeddings a WHERE 1 - list_cosine_similarity(a.embedding::DOUBLE[], [((k * 7) % 11 - 5) / 5.0 FOR k IN range(64)]::DOUBLE[]) <= 0.8")
def vector_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = [((k * 7) % 11 - 5) / 5.0 for k in range(64)]
    return kh.search(keyed(table(spark, sf_dir, "embeddings"), "vec", "vec_id"), col("embedding").vector_range(0.8), params={"query_vec": target}).select("vec_id")


# Relations around a keyspace


def _joined(how: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = kh.scan_hashes(hashes(table(spark, sf_dir, "customer"), "customer", "c_custkey"), "customer:*", {"c_custkey": int, "c_nationkey": int}, include_key=False)
        o = table(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
        out = c.join(o, "c_custkey", how)
        return out.fillna({"o_orderkey": -1, "o_totalprice": -1.0}) if how == "left" else out

    query(f"join_{how.removeprefix('left_')}", sql)(run)


_BIG = "(SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000)"
_CUSTOMER = "(SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer)"
_joined("inner", f"SELECT * FROM {_CUSTOMER} JOIN {_BIG} USING (c_custkey)")
_joined("left", f"SELECT c_custkey, c_nationkey, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(o_totalprice, -1) AS o_totalprice FROM {_CUSTOMER} LEFT JOIN {_BIG} USING (c_custkey)")
_joined("left_semi", f"SELECT * FROM {_CUSTOMER} SEMI JOIN {_BIG} USING (c_custkey)")
_joined("left_anti", f"SELECT * FROM {_CUSTOMER} ANTI JOIN {_BIG} USING (c_custkey)")


@query("union", "SELECT 'customer:' || c_custkey AS _key, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier:' || s_suppkey, s_acctbal FROM supplier")
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = kh.scan_hashes(hashes(table(spark, sf_dir, "customer"), "customer", "c_custkey"), "*", {"c_acctbal": float}).withColumnRenamed("c_acctbal", "balance")
    s = kh.scan_hashes(hashes(table(spark, sf_dir, "supplier"), "supplier", "s_suppkey"), "*", {"s_acctbal": float}).withColumnRenamed("s_acctbal", "balance")
    return c.unionByName(s)


@query("dedupe", "SELECT text, count(*) AS n, min(doc_id) AS doc_id FROM documents GROUP BY text HAVING count(*) > 1")
def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1")


@query("topk", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(100)


@query("hour_of_day", "SELECT hour(ts) AS hour, event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY ALL")
def hour_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.hour("ts").cast("long").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"))


# Geography

_PLACES = "(SELECT 'supplier:' || s_suppkey AS member, (s_suppkey * 37 % 3600) / 10.0 - 180.0 AS lon, (s_suppkey * 53 % 1700) / 10.0 - 85.0 AS lat FROM supplier)"
_HAVERSINE = "2 * 6372797.560856 * asin(least(1.0, sqrt(pow(sin((radians({lat}) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians({lat})) * pow(sin((radians({lon}) - radians(lon)) / 2), 2)))) / {m}"


@query("geo_radius", f"SELECT * FROM (SELECT member, lon AS longitude, lat AS latitude, round({_HAVERSINE.format(lon=-100.0, lat=40.0, m=1000.0)}, 4) AS distance FROM {_PLACES}) WHERE distance <= 5000")
def geo_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.geo_radius(places(spark, sf_dir), -100.0, 40.0, 5000, "km").withColumn("distance", F.round("distance", 4))


@query("geo_radius_by_member", f"SELECT member, round({_HAVERSINE.format(lon='x', lat='y', m=1609.34)}, 4) AS distance FROM {_PLACES} p, (SELECT lon AS x, lat AS y FROM {_PLACES} WHERE member = 'supplier:7') ORDER BY distance, member LIMIT 5")
def geo_radius_by_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.geo_radius_by_member(places(spark, sf_dir), "supplier:7", 15000, "mi", count=5, sort="ASC").select("member", rounded("distance"))


@query("geo_dist_matrix", f"SELECT p.member, {', '.join(f'''round(max(CASE WHEN q.member = 'supplier:{k}' THEN {_HAVERSINE.format(lon='q.lon', lat='q.lat', m=1000.0).replace('(lat)', '(p.lat)').replace('(lon)', '(p.lon)')} END), 4) AS s{k}''' for k in (1, 2, 3))} FROM {_PLACES} p, {_PLACES} q WHERE p.member IN ('supplier:1', 'supplier:2', 'supplier:3') AND q.member IN ('supplier:1', 'supplier:2', 'supplier:3') GROUP BY p.member")
def geo_dist_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"supplier:{k}" for k in (1, 2, 3)]
    out = kh.geo_dist_matrix(places(spark, sf_dir), names)
    return out.select("member", *(F.round(F.col(f"`{n}`"), 4).alias(f"s{n.split(':')[1]}") for n in names))


@query("geo_polygon", f"SELECT member FROM {_PLACES} WHERE lon >= -100 AND lon < 20 AND lat >= -30 AND lat < 50 AND (lat + 30) < (lon + 100) * 80.0 / 120.0")
def geo_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = places(spark, sf_dir).select("member", F.concat_ws(",", "lon", "lat").alias("at"))
    return p.where(col("at").within_polygon([(-100.0, -30.0), (20.0, -30.0), (20.0, 50.0)]).to_column()).select("member")


_BITS = lambda k: " + ".join(f"{1 << (4 - b % 5)} * (CAST(floor({'(lon + 180) / 360' if b % 2 == 0 else '(lat + 90) / 180'} * {float(1 << (b // 2 + 1))}) AS BIGINT) % 2)" for b in range(5 * k, 5 * k + 5))


@query("geo_hash", f"SELECT member, {' || '.join(f'substr(z, 1 + CAST({_BITS(k)} AS INT), 1)' for k in range(11))} AS geohash FROM {_PLACES}, (SELECT '0123456789bcdefghjkmnpqrstuvwxyz' AS z)")
def geo_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.geo_hash(places(spark, sf_dir))


@query("geo_pos", f"SELECT a.member, lon AS longitude, lat AS latitude FROM (VALUES ('supplier:3'), ('supplier:9'), ('nobody')) a(member) LEFT JOIN {_PLACES} p USING (member)")
def geo_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.geo_pos(places(spark, sf_dir), ["supplier:3", "supplier:9", "nobody"])


@query("geo_dist", f"SELECT round({_HAVERSINE.format(lon='x', lat='y', m=1000.0)}, 4) AS km FROM {_PLACES} p, (SELECT lon AS x, lat AS y FROM {_PLACES} WHERE member = 'supplier:7') WHERE member = 'supplier:2'")
def geo_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(kh.geo_dist(places(spark, sf_dir), "supplier:7", "supplier:2"),)], "km double").select(rounded("km"))


# Writers: the state after a write, as a plan


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers up to 100, as they are; and from 51 on with other balances and no name."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = c.where("c_custkey > 50").select("c_custkey", F.lit(None).cast("string").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return write.hash_rows(c.where("c_custkey <= 100"), "c_custkey", "customer:"), write.hash_rows(new, "c_custkey", "customer:")


def _written(mode: str, name: str, balance: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old, new = _halves(spark, sf_dir)
        out = write.merged_hashes(old, new, mode)
        return out.select("_key", "c_name", F.round(F.col("c_acctbal").cast("double"), 2).alias("c_acctbal"))

    query(f"write_{mode}", f"SELECT 'customer:' || c_custkey AS _key, {name} AS c_name, round({balance}, 2) AS c_acctbal FROM customer")(run)


_written("replace", "CASE WHEN c_custkey <= 50 THEN c_name END", "CASE WHEN c_custkey > 50 THEN c_acctbal + 1 ELSE c_acctbal END")
_written("append", "CASE WHEN c_custkey <= 100 THEN c_name END", "CASE WHEN c_custkey > 50 THEN c_acctbal + 1 ELSE c_acctbal END")
_written("fail", "CASE WHEN c_custkey <= 100 THEN c_name END", "CASE WHEN c_custkey > 100 THEN c_acctbal + 1 ELSE c_acctbal END")


@query("write_json", "SELECT 'nation:' || n_nationkey AS _key, CAST(n_regionkey AS BIGINT) AS n_regionkey, n_name FROM nation")
def write_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.scan_json(write.json_rows(table(spark, sf_dir, "nation"), "n_nationkey", "nation:"), "nation:*", {"n_regionkey": int, "n_name": str})


@query("write_zset_append", "SELECT 'nation:' || c_nationkey AS _key, 'c' || c_custkey AS member, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 10 ELSE c_acctbal END AS score FROM customer")
def write_zset_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string")).alias("_key"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("member"), F.col("c_acctbal").alias("score"), "c_custkey")
    new = c.where("c_custkey % 2 = 0").withColumn("score", F.col("score") + 10)
    return kh.scan_zsets(write.merged("zset", write.zset_rows(c), write.zset_rows(new), "append"), "nation:*")


def _target(spark: SparkSession) -> str:
    """A table of its own in the shared folder."""
    return f"{run_dir(spark)}/target-{uuid.uuid4().hex}"


@query("write_hashes_numbered", "SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders, count(*) AS keys, max(n) AS last FROM (SELECT l_orderkey, row_number() OVER () - 1 AS n FROM lineitem)")
def write_hashes_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem under keys that are made for it: how many there are, and the last one."""
    path = _target(spark)
    n = kh.write_hashes(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"), path, key_column=None, key_prefix="line:")
    number = F.substring("_key", 6, 20).cast("long")
    return kh.Table(path).read().agg(F.lit(n).cast("long").alias("n"), F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("_key").alias("keys"), F.max(number).alias("last"))


@query("write_strings", "SELECT 'nation:' || n_nationkey AS _key, n_name AS value FROM nation")
def write_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _target(spark)
    kh.write_strings(table(spark, sf_dir, "nation"), path, key_column="n_nationkey", value_column="n_name", key_prefix="nation:")
    return kh.scan_strings(kh.Table(path).read(), "nation:*")


@query("write_set_append", "SELECT DISTINCT 'order:' || l_orderkey AS _key, CAST(l_suppkey AS VARCHAR) AS member FROM lineitem")
def write_set_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyed(table(spark, sf_dir, "lineitem"), "order", "l_orderkey").select("_key", F.col("l_suppkey").alias("member"), "l_linenumber")
    return kh.scan_sets(write.merged("set", write.set_rows(rows.where("l_linenumber < 4")), write.set_rows(rows.where("l_linenumber > 2")), "append"), "order:*")


@query("write_list_append", "SELECT 'nation:' || c_nationkey AS _key, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey > 700, c_custkey) - 1 AS position, CAST(c_custkey AS VARCHAR) AS element FROM customer")
def write_list_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string")).alias("_key"), F.col("c_custkey").alias("element"), "c_custkey")
    made = [write.list_rows(c.where(part), index_column="c_custkey") for part in ("c_custkey <= 700", "c_custkey > 700")]
    return kh.scan_lists(write.merged("list", *made, "append"), "nation:*", include_position=True)


def _nations(spark: SparkSession, sf_dir: str, ttl: float | None = None) -> str:
    path = _target(spark)
    kh.write_hashes(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), path, key_column="n_nationkey", key_prefix="nation:", ttl=ttl, now=1000.0)
    return path


_ASKED = "(SELECT 'nation:' || k AS _key, k FROM (VALUES (1), (2), (3), (99)) t(k))"


@query("keys_ttl", f"SELECT _key, CAST(CASE k WHEN 99 THEN -2 WHEN 1 THEN 30 WHEN 2 THEN -1 ELSE 90 END AS BIGINT) AS ttl FROM {_ASKED}")
def keys_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that live for 100 seconds, ten of them gone; one of them then for 30, one for ever."""
    path = _nations(spark, sf_dir, 100.0)
    kh.set_ttl(path, ["nation:1", "nation:99"], 30.0, now=1010.0)
    kh.persist_keys(path, ["nation:2"], now=1010.0)
    return kh.get_ttl(path, [f"nation:{k}" for k in (1, 2, 3, 99)], now=1010.0)


@query("keys_exist", f"SELECT _key, k <> 99 AS exists FROM {_ASKED}")
def keys_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kh.exists_keys(_nations(spark, sf_dir), [f"nation:{k}" for k in (1, 2, 3, 99)], now=1010.0)


@query("keys_deleted", "SELECT 'nation:' || n_nationkey AS _key, n_name FROM nation WHERE n_nationkey NOT IN (1, 2, 3) AND 'nation:' || n_nationkey NOT LIKE 'nation:1_'")
def keys_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _nations(spark, sf_dir)
    kh.delete_keys(path, ["nation:1", "nation:2", "nation:3", "nation:99"], now=1010.0)
    kh.delete_keys_pattern(path, "nation:1?", now=1010.0)
    return kh.Table(path).read().select("_key", "n_name")


@query("read_stream", f"SELECT _id, _ts, event_type FROM (SELECT ms || '-' || seq AS _id, ms AS _ts, event_type, row_number() OVER (ORDER BY ms, seq) AS n FROM {_EVENTS} WHERE _key = 'user:7') WHERE n BETWEEN 4 AND 8")
def read_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery of a group, after one of three entries."""
    group, log = kh.Group(_target(spark)), event_log(spark, sf_dir)
    kh.read_stream(log, "user:7", schema=["event_type"], group=group, consumer="a", count=3)
    return kh.read_stream(log, "user:7", schema=["event_type"], group=group, consumer="b", count=5, include_key=False)


@query("replicate_filter", "SELECT event_id FROM events WHERE event_type <> 'click' AND value >= 50 AND event_type IN ('purchase', 'view')")
def replicate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = hashes(table(spark, sf_dir, "events"), "event", "event_id")
    f = kh.field_filter
    return e.where(f("event_type").ne("click") & f("value").gte(50) & f("event_type").in_list(["purchase", "view"])).select(F.col("event_id").cast("long").alias("event_id"))


# Keys, schemas, streams, cache


@query("rename_keys", "SELECT CASE WHEN n_nationkey < 5 THEN 'land:' || n_nationkey ELSE 'nation:' || n_nationkey END AS _key, n_name FROM nation")
def rename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.operators.keys import renamed

    n = keyed(table(spark, sf_dir, "nation"), "nation", "n_nationkey")
    names = n.where("n_nationkey < 5").select("_key", F.concat(F.lit("land:"), F.col("n_nationkey").cast("string")).alias("new"))
    return renamed(n.select("_key", "n_name"), names)


_KINDS = ("event_id", "event_type", "props", "ts", "user_id", "value")


@query("infer_schema", " UNION ALL ".join(f"SELECT '{c}' AS field, CASE WHEN count(*) = count(try_cast(CAST({c} AS VARCHAR) AS BIGINT)) AND NOT bool_or(contains(CAST({c} AS VARCHAR), '.')) THEN 'long' WHEN count(*) = count(try_cast(CAST({c} AS VARCHAR) AS DOUBLE)) THEN 'double' ELSE 'string' END AS type, CAST(1 AS DOUBLE) AS confidence FROM events" for c in _KINDS))
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kh.infer_hash_schema_with_confidence(hashes(table(spark, sf_dir, "events"), "event", "event_id"), 1000)
    return spark.createDataFrame([(n, i.type, i.confidence) for n, i in found.field_info.items()], "field string, type string, confidence double")


@query("stream_available_now", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda e: e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


@query("stream_tumbling", "SELECT epoch_us(ts) // 21600000000 * 21600000 AS start_ms, count(*) AS n FROM events GROUP BY 1")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _streamed(spark, sf_dir, lambda e: e.groupBy((F.floor(millis("ts") / 21600000) * 21600000).cast("long").alias("start_ms")).agg(F.count(F.lit(1)).alias("n")))
    return out


def _streamed(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The result of a streaming aggregate over all that is there, which each batch writes anew."""
    path, source = f"{run_dir(spark)}/stream-{uuid.uuid4().hex}", f"{sf_dir}/events.parquet"
    folder, file = source.rsplit("/", 1)
    e = spark.readStream.schema(spark.read.parquet(source).schema).option("pathGlobFilter", file if not file.endswith("/") else "*").parquet(folder)
    result = of(e)

    def save(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/result")

    result.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/checkpoint").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{path}/result")


@query("cache_roundtrip", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def cache_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark)}/cache"
    df = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    kh.cache_dataframe(df, path, f"flags:{sf_dir}", compression="zstd")
    return kh.get_cached_dataframe(path, f"flags:{sf_dir}")


@query("cache_lineitem", "SELECT * FROM lineitem")
def cache_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem, written to a cache and read from it."""
    path = f"{run_dir(spark)}/cache-{uuid.uuid4().hex}"
    kh.cache_dataframe(table(spark, sf_dir, "lineitem"), path, "lineitem", compression="zstd")
    return kh.get_cached_dataframe(path, "lineitem")
