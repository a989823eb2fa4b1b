"""Predicates: their search syntax, what is split off, and that negation keeps rows without the field."""

import pytest
from pyspark.sql import functions as F

import keyharbor as kh
from keyharbor.operators.fields import NumericField, TagField, TextField, VectorField
from keyharbor.operators.query import Context, col, cols, match_all, match_none, polygon_wkt, raw

SYNTAX = [
    (col("age") > 30, "@age:[(30 +inf]"),
    (col("age") >= 30, "@age:[30 +inf]"),
    (col("age") < 30, "@age:[-inf (30]"),
    (col("age") <= 30, "@age:[-inf 30]"),
    (col("age") == 30, "@age:[30 30]"),
    (col("age") != 30, "-@age:[30 30]"),
    (col("status") == "active", "@status:{active}"),
    (col("status") == True, "@status:{true}"),  # noqa: E712
    (col("status") != "deleted", "-@status:{deleted}"),
    (~(col("status") == "deleted"), "-(@status:{deleted})"),
    (col("age").is_between(20, 40), "@age:[20 40]"),
    ((col("age") > 1) & (col("s") == "a"), "@age:[(1 +inf] @s:{a}"),
    ((col("age") > 1) | (col("s") == "a"), "(@age:[(1 +inf] | @s:{a})"),
    ((col("s") == "a") | (col("s") == "b") | (col("s") == "c d"), "@s:{a|b|c\\ d}"),
    (((col("a") > 1) & (col("b") > 2)) | (col("c") > 3), "((@a:[(1 +inf] @b:[(2 +inf]) | @c:[(3 +inf])"),
    (((col("a") > 1) | (col("b") > 2)) & (col("c") > 3), "((@a:[(1 +inf] | @b:[(2 +inf])) @c:[(3 +inf]"),
    (col("s").is_in(["x"]), "@s:{x}"),
    (col("s").is_in([]), "-*"),
    (match_all(), "*"),
    (match_none(), "-*"),
    (raw("a > 1"), "a > 1"),
    (col("t").contains("python"), "@t:python"),
    (col("t").contains("a-b (c)"), "@t:a\\-b \\(c\\)"),
    (col("n").starts_with("jo"), "@n:jo*"),
    (col("n").ends_with("son"), "@n:*son"),
    (col("n").contains_substring("sun"), "@n:*sun*"),
    (col("n").matches("j*n"), "@n:j*n"),
    (col("n").matches_exact("j*n"), "@n:\"w'j*n'\""),
    (col("n").fuzzy("john"), "@n:%john%"),
    (col("n").fuzzy("john", 2), "@n:%%john%%"),
    (col("n").fuzzy("john", 9), "@n:%%%john%%%"),
    (col("t").phrase("hello", "world"), "@t:(hello world)"),
    (col("t").phrase("hello", "world", slop=2, inorder=True), "@t:(hello world) => { $slop: 2; $inorder: true; }"),
    (col("c").has_tag("science"), "@c:{science}"),
    (col("c").has_any_tag(["urgent", "important"]), "@c:{urgent|important}"),
    (col("l").within_radius(-122.4, 37.7, 10, "km"), "@l:[-122.4 37.7 10 km]"),
    (col("l").within_polygon([(0, 0), (1, 0), (1, 1)]), "@l:[WITHIN $poly]"),
    (col("e").knn(10), "*=>[KNN 10 @e $query_vec]"),
    (col("e").vector_range(0.5), "@e:[VECTOR_RANGE 0.5 $query_vec]"),
    (col("m").is_null(), "ismissing(@m)"),
    (col("m").is_not_null(), "-ismissing(@m)"),
    (col("t").contains("x").boost(2.0), "(@t:x) => { $weight: 2.0; }"),
    (col("t").contains("x").optional(), "~@t:x"),
    (cols("title", "body").contains("python"), "@title|body:python"),
    (cols("title", "body").starts_with("py"), "@title|body:py*"),
]


@pytest.mark.parametrize("query, said", SYNTAX, ids=[s for _, s in SYNTAX])
def test_search_syntax(query, said):
    assert query.to_query() == str(query) == said


def test_split_of_sides(spark):
    server, client = col("age") > 30, col("email").matches_regex("@x")
    both = server & client
    assert not server.is_client_side and both.is_client_side
    assert both.get_server_filter().to_query() == "@age:[(30 +inf]" and both.get_client_filter().op == "regex"
    either = server | client
    assert either.get_server_filter() is None and either.get_client_filter() is either
    assert "none" in server.explain() and "RLIKE" in both.explain().upper()


def test_mistakes_are_said():
    with pytest.raises(TypeError, match="parentheses"):
        (col("a") > 1) & col("b") >= 4  # noqa: B015
    with pytest.raises(TypeError):
        (col("a") > 1) >= 4  # noqa: B015
    with pytest.raises(TypeError):
        bool(col("a") > 1)
    with pytest.raises(ValueError, match="no filter"):
        col("v").knn(3).to_column()
    with pytest.raises(ValueError, match="unknown unit"):
        col("l").within_radius(0, 0, 1, "parsec")
    assert polygon_wkt(col("l").within_polygon([(0, 0), (1, 0), (1, 1)])) == "POLYGON((0 0, 1 0, 1 1, 0 0))"


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Jon Smith", "red, Blue", 30, "x@gmail.com", [1, 2], '{"a": {"b": 3}, "s": "q"}'), (2, "John Smythe", "green", None, None, None, None), (3, "the quick brown fox", None, 41, "Y@GMAIL.com", [], '{"a": {}}'), (4, None, "blue", 12, "", [2, 3, 4], "[]")]
    return spark.createDataFrame(rows, "id int, name string, tags string, age int, email string, list array<int>, doc string")


FOUND = [
    (col("age") > 20, {1, 3}),
    (~(col("age") > 20), {2, 4}),
    (col("age") != 30, {2, 3, 4}),
    (~(col("name").contains("smith")), {2, 3, 4}),
    (col("name").contains("smith jon"), {1}),
    (col("name").fuzzy("jon", 1), {1, 2}),
    (col("name").phrase("quick", "fox"), set()),
    (col("name").phrase("quick", "fox", slop=1), {3}),
    (col("name").phrase("fox", "quick", slop=1, inorder=False), {3}),
    (col("name").phrase("fox", "quick", slop=1, inorder=True), set()),
    (col("name").starts_with("smy"), {2}),
    (col("name").matches("sm?th*"), {1, 2}),
    (col("tags").has_tag("BLUE"), {1, 4}),
    (col("tags") == "blue", {1, 4}),
    (col("tags").starts_with("gr"), {2}),
    (col("tags").is_null(), {3}),
    (col("email").iequals("y@gmail.com"), {3}),
    (col("email").contains_any(["gmail", "hotmail"]), {1}),
    (col("name").similar_to("Jon Smyth", 0.8), {1, 2}),
    (col("list").array_contains(2), {1, 4}),
    (col("list").array_len() >= 2, {1, 4}),
    (~(col("list").array_len() > 0), {2, 3}),
    (col("doc").json_path("$.a.b") == 3, {1}),
    (col("doc").json_path("$.s") == "q", {1}),
    (raw("age % 2 = 0"), {1, 4}),
    (match_none() | (col("age") == 12), {4}),
]


@pytest.mark.parametrize("query, ids", FOUND, ids=[str(k) for k in range(len(FOUND))])
def test_what_is_found(people, query, ids):
    context = Context({"tags": TagField("tags"), "name": TextField("name"), "age": NumericField("age")})
    assert {r["id"] for r in people.where(query.to_column(context)).collect()} == ids


def test_equality_is_plain_without_a_declared_tag(people):
    assert {r["id"] for r in people.where((col("tags") == "blue").to_column()).collect()} == {4}


def test_geo_and_vectors(spark):
    df = spark.createDataFrame([("New York", "-74.006,40.7128", [1.0, 0.0]), ("Los Angeles", "-118.2437,34.0522", [0.0, 1.0]), ("Chicago", "-87.6298,41.8781", [1.0, 1.0]), ("nowhere", None, None)], "name string, at string, v array<float>")
    found = lambda q, **c: {r["name"] for r in df.where(q.to_column(Context(**c))).collect()}
    assert found(col("at").within_radius(-87.0, 41.0, 200)) == {"Chicago"}
    assert found(col("at").within_polygon([(-90.0, 38.0), (-70.0, 38.0), (-70.0, 44.0), (-90.0, 44.0)])) == {"New York", "Chicago"}
    assert found(col("v").vector_range(0.3), params={"query_vec": [1, 0]}) == {"New York", "Chicago"}
    assert found(col("v").vector_range(1.0), params={"query_vec": [1, 0]}, fields={"v": VectorField("v", distance_metric="L2")}) == {"New York", "Chicago"}


def test_the_outline_of_a_polygon(spark):
    """Lower edges and left ends belong to it, upper edges and right ends don't; neighbours share no point."""
    at = [(x, y) for x in range(-100, 21, 15) for y in range(-30, 51, 10)]
    df = spark.createDataFrame([(f"{x}.0,{y}.0",) for x, y in at], "at string")
    found = lambda *points: {r["at"] for r in df.where(col("at").within_polygon(list(points)).to_column()).collect()}
    low, corner, high, left = (-100.0, -30.0), (20.0, -30.0), (20.0, 50.0), (-100.0, 50.0)
    below, above = found(low, corner, high), found(left, high, low)
    assert below == {f"{x}.0,{y}.0" for x, y in at if x < 20 and (y + 30) < (x + 100) * 80.0 / 120.0} == found(high, corner, low, high)
    assert above == {f"{x}.0,{y}.0" for x, y in at if x < 20 and y < 50} - below


def test_sketches_beside_distinct_counts(spark):
    """Values are made distinct before a sketch takes them: no sketch for each value. The sketch is the same."""
    df = spark.range(5000).selectExpr("id % 3 AS g", "id % 700 AS x", "id % 50 AS y")
    both = kh.aggregate(df, group_by=["g"], reduce=[("COUNT_DISTINCTISH", ["@x"], "near"), ("COUNT_DISTINCTISH", ["y"], "near_y"), ("COUNT_DISTINCT", ["@x"], "n")])
    alone = kh.aggregate(df, group_by=["g"], reduce=[("COUNT_DISTINCTISH", ["@x"], "near"), ("COUNT_DISTINCTISH", ["y"], "near_y")])
    assert sorted(both.select("g", "near", "near_y").collect()) == sorted(alone.collect()) and {r["n"] for r in both.collect()} == {700}
    one = kh.aggregate(df, group_by=["g"], reduce=[("COUNT_DISTINCTISH", ["@x"], "near"), ("COUNT_DISTINCT", ["@x"], "n")])
    assert "partial_approx_count_distinct" not in one._jdf.queryExecution().sparkPlan().toString().split("Aggregate")[-1]


def test_predicates_reach_the_scan(spark, data):
    df = spark.read.parquet(f"{data}/orders.parquet").where(((col("o_totalprice") > 100000) & (col("o_orderstatus") == "F")).to_column()).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan and "o_comment" not in plan and F is not None
