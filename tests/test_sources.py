"""Scans, typed parsing, writers, keys, schemas, caches and indexes."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

import keyharbor as kh
from keyharbor.errors import IndexNotFound, VersionConflict
from keyharbor.functions.parse import parsed
from keyharbor.sources import write


@pytest.fixture
def path():
    return f"/tmp/checkpoints/keyharbor-tests/{uuid.uuid4().hex}"


PARSED = [
    ("long", {"42": 42, "-7": -7, "+5": 5, " 42 ": None, "4.0": None, "": None, "99999999999999999999": None, "abc": None}),
    ("double", {"1.5": 1.5, "inf": float("inf"), "-inf": float("-inf"), "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1d": None, " 1": None, "": None, "x": None}),
    ("boolean", {"true": True, "T": True, "1": True, "YES": True, "f": False, "no": False, '"true"': True, "'0'": False, "2": None, "": None}),
    ("date", {"19738": datetime.date(2024, 1, 16), "2023-02-30": datetime.date(2023, 3, 2), "2024-01-15T10:00:00": datetime.date(2024, 1, 15), "2024-13-01": None, "2024-1-5": datetime.date(2024, 1, 5), "x": None}),
    ("datetime", {"1700000000": datetime.datetime(2023, 11, 14, 22, 13, 20), "1700000000123": datetime.datetime(2023, 11, 14, 22, 13, 20, 123000), "1700000000123456": datetime.datetime(2023, 11, 14, 22, 13, 20, 123456), "2024-01-15T10:30:00.5Z": datetime.datetime(2024, 1, 15, 10, 30, 0, 500000), "2024-01-15 10:30:00+05:00": datetime.datetime(2024, 1, 15, 10, 30), "2024-01-15": datetime.datetime(2024, 1, 15), "soon": None}),
]


@pytest.mark.parametrize("kind, cases", PARSED, ids=[k for k, _ in PARSED])
def test_parsing(spark, kind, cases):
    df = spark.createDataFrame([(s,) for s in cases], "s string").repartition(1)
    assert {r["s"]: r["v"] for r in df.select("s", parsed(F.col("s"), kind, strict=False).alias("v")).collect()} == cases
    bad = df.where(F.col("s").isin([s for s, v in cases.items() if v is None]))
    with pytest.raises(Exception, match="not a"):
        bad.select(parsed(F.col("s"), kind)).collect()
    assert spark.createDataFrame([(None,)], "s string").select(parsed(F.col("s"), kind).alias("v")).first()["v"] is None


@pytest.fixture(scope="module")
def users(spark):
    rows = [(f"user:{i}", f"User {i}", str(20 + i % 50), "true" if i % 2 else "no", None if i % 10 else 50.0 * i) for i in range(50)]
    return spark.createDataFrame(rows, "_key string, name string, age string, active string, _expire_at double")


def test_scan_hashes(users):
    df = kh.scan_hashes(users, "user:1*", {"name": str, "age": int, "active": bool, "missing": float}, include_row_index=True, include_ttl=True, now=100.0)
    assert df.columns == ["_index", "_key", "_ttl", "name", "age", "active", "missing"]
    rows = df.collect()
    assert len(rows) == 11 and sorted(r["_index"] for r in rows) == list(range(11)) and all(r["missing"] is None for r in rows)
    assert {r["_key"]: r["_ttl"] for r in rows}["user:10"] == 400 and sorted(rows, key=lambda r: r["_index"]) == sorted(rows, key=lambda r: r["_key"])
    assert kh.scan_hashes(users, "*", {"age": int}, now=600.0).count() == 48  # two have expired
    assert kh.scan_hashes(users, "*", {"age": int}, n_rows=5, include_key=False, now=0.0).where("age >= 0").count() == 5
    with pytest.raises(TypeError, match="unknown options"):
        kh.scan_hashes(users, "*", {"age": int}, colour="red")
    with pytest.raises(ValueError):
        kh.scan_hashes(users)
    options = kh.HashScanOptions(pattern="user:2?", include_key=False)
    assert kh.scan_hashes(users, "ignored", {"name": str}, options=options, now=0.0).count() == 10


def test_only_what_is_asked_is_read(spark, data, users):
    orders = spark.read.parquet(f"{data}/orders.parquet").withColumn("_key", F.col("o_orderkey").cast("string"))
    plan = kh.scan_hashes(orders, "*", {"o_totalprice": float, "o_orderstatus": str}).select("o_orderstatus")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan.split("ReadSchema")[-1]
    assert kh.scan_hashes(users, "*", {"age": int}, now=-1.0).select().count() == 50


def test_scan_json(spark):
    docs = [("d:1", '{"t": "x", "n": 3, "f": 2.9, "b": true, "o": {"p": [1]}}'), ("d:2", '{"t": null, "n": 4.7}'), ("d:3", "{}")]
    df = spark.createDataFrame(docs, "_key string, doc string")
    rows = {r["_key"]: r for r in kh.scan_json(df, "d:*", {"t": str, "n": int, "f": float, "b": bool, "o": str}).collect()}
    assert (rows["d:1"]["t"], rows["d:1"]["n"], rows["d:1"]["f"], rows["d:1"]["b"], rows["d:1"]["o"]) == ("x", 3, 2.9, True, '{"p":[1]}')
    assert rows["d:2"]["n"] == 4 and rows["d:2"]["t"] is None and rows["d:3"]["n"] is None
    with pytest.raises(Exception, match="is not a"):
        kh.scan_json(df, "*", {"t": int}).collect()
    assert kh.scan_json(df, "*", {"t": int}, strict=False).where("t IS NOT NULL").count() == 0


def test_collections(spark):
    df = spark.createDataFrame([("k", ["a", "b", "a"]), ("e", [])], "_key string, members array<string>")
    assert sorted(r["member"] for r in kh.scan_sets(df).collect()) == ["a", "b"]
    rows = kh.scan_lists(df.withColumnRenamed("members", "elements"), include_position=True).collect()
    assert [(r["position"], r["element"]) for r in rows] == [(0, "a"), (1, "b"), (2, "a")]
    z = spark.createDataFrame([("k", [("b", 1.0), ("a", 1.0), ("c", 0.5)])], "_key string, members array<struct<member string, score double>>")
    assert [(r["rank"], r["member"], r["score"]) for r in kh.scan_zsets(z, include_rank=True).collect()] == [(0, "c", 0.5), (1, "a", 1.0), (2, "b", 1.0)]


def test_streams_and_series(spark):
    log = spark.createDataFrame([("s", 1000, 0, {"a": "1", "b": "2"}), ("s", 1000, 1, {"a": "3"}), ("s", 2000, 0, {"b": "4"}), ("t", 5, 5, {})], "_key string, ms long, seq long, fields map<string,string>")
    rows = kh.scan_streams(log, "s", fields=["a", "b"], include_sequence=True).orderBy("_ts", "_seq").collect()
    assert [(r["_id"], r["a"], r["b"]) for r in rows] == [("1000-0", "1", "2"), ("1000-1", "3", None), ("2000-0", None, "4")]
    ids = lambda **k: sorted(r["_id"] for r in kh.scan_streams(log, "s", fields=[], **k).collect())
    assert ids(start_id="1000-1") == ["1000-1", "2000-0"] and ids(end_id="1000") == ["1000-0", "1000-1"] and ids(start_id="(1000-0", count_per_stream=1) == ["1000-1"]
    series = spark.createDataFrame([("k", 0, 1.0, {"u": "c"}), ("k", 1500, 3.0, {"u": "c"}), ("k", 2500, 5.0, {"u": "c"})], "_key string, ts long, value double, labels map<string,string>")
    rows = kh.scan_timeseries(series, aggregation="avg", bucket_size_ms=2000, labels=["u"]).orderBy("_ts").collect()
    assert [(r["_ts"], r["value"], r["u"]) for r in rows] == [(0, 2.0, "c"), (2000, 5.0, "c")]
    assert kh.scan_timeseries(series, start=1, end=1500).count() == 1
    with pytest.raises(ValueError, match="aggregation"):
        kh.scan_timeseries(series, aggregation="mode", bucket_size_ms=1)


def test_write_modes(spark, path):
    first = spark.createDataFrame([("a", "x", 1), ("b", "y", None), ("n", None, None)], "_key string, s string, n int")
    assert kh.write_hashes(first, path) == 2
    held = lambda: {r["_key"]: (r["s"], r["n"]) for r in kh.Table(path).read().collect()}
    assert held() == {"a": ("x", "1"), "b": ("y", None)}
    more = spark.createDataFrame([("a", None, 5), ("c", "z", 6)], "_key string, s string, n int")
    assert kh.write_hashes(more, path, if_exists="append") == 2
    assert held() == {"a": ("x", "5"), "b": ("y", None), "c": ("z", "6")}
    result = kh.write_hashes_detailed(spark.createDataFrame([("a", "no", 0), ("d", "w", 7)], "_key string, s string, n int"), path, if_exists="fail")
    assert (result.keys_written, result.keys_skipped, result.succeeded_keys) == (1, 1, ["d"]) and held()["a"] == ("x", "5")
    assert kh.write_hashes(spark.createDataFrame([("a", None, None), ("b", "new", None)], "_key string, s string, n int"), path) == 1
    assert held() == {"b": ("new", None), "c": ("z", "6"), "d": ("w", "7")}
    with pytest.raises(ValueError):
        kh.write_hashes(first, path, if_exists="maybe")
    with pytest.raises(ValueError, match="no column"):
        kh.write_hashes(first, path, key_column="id")


def test_other_writers(spark, path):
    df = spark.createDataFrame([("k", "a", 1.0, 2), ("k", "b", 2.0, 1), ("k", "a", 3.0, 3), ("k", None, 1.0, 4)], "_key string, member string, score double, i int").coalesce(1)
    assert kh.write_sets(df.select("_key", "member"), f"{path}/s") == 1
    kh.write_sets(spark.createDataFrame([("k", "z")], "_key string, member string"), f"{path}/s", if_exists="append")
    assert sorted(r["member"] for r in kh.scan_sets(kh.Table(f"{path}/s").read()).collect()) == ["a", "b", "z"]
    kh.write_lists(df.withColumnRenamed("member", "element"), f"{path}/l", index_column="i")
    kh.write_lists(spark.createDataFrame([("k", "z")], "_key string, element string"), f"{path}/l", if_exists="append")
    assert [r["element"] for r in kh.scan_lists(kh.Table(f"{path}/l").read(), include_position=True).orderBy("position").collect()] == ["b", "a", "a", "z"]
    kh.write_zsets(df, f"{path}/z")
    assert [(r["member"], r["score"], r["rank"]) for r in kh.scan_zsets(kh.Table(f"{path}/z").read(), include_rank=True).orderBy("rank").collect()] == [("b", 2.0, 0), ("a", 3.0, 1)]
    kh.write_zsets(spark.createDataFrame([("k", "a", 1.0), ("m", "q", 1.0)], "_key string, member string, score double"), f"{path}/z", if_exists="append", ttl=5.0, now=100.0)
    assert {tuple(r) for r in kh.Table(f"{path}/z").read().select("_key", "member", "score", "_expire_at").collect()} == {("k", "a", 1.0, 105.0), ("k", "b", 2.0, 105.0), ("m", "q", 1.0, 105.0)}
    with pytest.raises(TypeError, match="which is no set"):
        kh.write_sets(df.select("_key", "member"), f"{path}/z")
    assert kh.write_strings(spark.createDataFrame([(1, True), (2, None)], "id int, value boolean"), f"{path}/v", key_column="id", key_prefix="v:") == 1
    assert kh.scan_strings(kh.Table(f"{path}/v").read(), value_type=bool).first()["value"] is True
    assert kh.write_json(spark.createDataFrame([("k", 1, None)], "_key string, n int, s string"), f"{path}/j") == 1
    assert kh.Table(f"{path}/j").read().first()["doc"] == '{"n":1}'
    assert {r["_key"] for r in write.hash_rows(spark.createDataFrame([("x",), ("y",)], "s string").coalesce(1), None, "r:").collect()} == {"r:0", "r:1"}


def test_multi_destination(spark, path):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "_key string, s string")

    def broken(_):
        raise RuntimeError("no")

    out = kh.write_hashes_multi(df, [kh.Destination(f"{path}/1", key_prefix="p:"), kh.Destination(f"{path}/2", transform=lambda d: d.where("s = 'x'")), kh.Destination(f"{path}/3", transform=broken, name="third")])
    assert (out.total_keys_written, out.all_succeeded, out.failed_destinations) == (3, False, ["third"])
    assert {r["_key"] for r in kh.Table(f"{path}/1").read().collect()} == {"p:a", "p:b"}


def test_keys(spark, path):
    kh.write_hashes(spark.createDataFrame([(f"k:{i}", str(i)) for i in range(6)], "_key string, v string"), path)
    assert kh.set_ttl(path, ["k:0", "nope"], 60, now=1000.0) == kh.TtlResult(1, 1, [("nope", "Key does not exist")])
    ttl = lambda now: {r["_key"]: r["ttl"] for r in kh.get_ttl(path, ["k:0", "k:1", "nope"], now=now).collect()}
    assert ttl(1010.0) == {"k:0": 50, "k:1": -1, "nope": -2} and ttl(2000.0)["k:0"] == -2
    assert kh.persist_keys(path, ["k:0"], now=1010.0).succeeded == 1 and ttl(2000.0)["k:0"] == -1
    assert kh.set_ttl_from_column(path, spark.createDataFrame([("k:1", 5.0)], "_key string, ttl double"), now=1000.0).succeeded == 1
    assert {r["_key"]: r["exists"] for r in kh.exists_keys(path, ["k:1", "zz"], now=1001.0).collect()} == {"k:1": True, "zz": False}
    assert kh.rename_keys(path, {"k:2": "k:3", "zz": "y"}, now=0.0).succeeded == 1
    rows = {r["_key"]: r["v"] for r in kh.Table(path).read().collect()}
    assert "k:2" not in rows and rows["k:3"] == "2"
    assert kh.delete_keys(path, ["k:4", "zz"], now=0.0) == kh.DeleteResult(1, 1)
    assert kh.delete_keys_pattern(path, "k:[13]", now=0.0).deleted == 2
    assert {r["_key"] for r in kh.Table(path).read().collect()} == {"k:0", "k:5"}


def test_inference(spark):
    rows = [(f"k:{i}", str(i), f"{i}.5", "yes" if i % 2 else "no", "7" if i < 8 else "x", "Y" if i < 3 else "word", None) for i in range(10)]
    df = spark.createDataFrame(rows, "_key string, n string, f string, b string, mostly string, s string, nothing string")
    found = kh.infer_hash_schema_with_confidence(df)
    assert found.schema == {"b": "boolean", "f": "double", "mostly": "long", "n": "long", "nothing": "string", "s": "string"}
    assert found.field_info["mostly"].confidence == 0.8 and found.low_confidence_fields() == ["mostly"] and not found.all_confident and found.field_info["nothing"].nulls == 10
    assert kh.infer_hash_schema(df, type_inference=False)["n"] == "string" and kh.infer_hash_schema_with_overwrite(df, {"n": "string", "extra": "long"})["extra"] == "long"
    docs = spark.createDataFrame([("1", '{"a": 1, "b": 2.5, "c": true, "d": "x", "e": 1, "o": {"p": 1, "q": [1, 2]}}'), ("2", '{"a": 2, "e": 1.5, "d": null}')], "_key string, doc string")
    assert kh.infer_json_schema(docs) == {"a": "long", "b": "double", "c": "boolean", "d": "string", "e": "double", "o": "string"}


def test_cache(spark, path):
    df = spark.range(100).withColumn("s", F.lit("x"))
    assert kh.cache_dataframe(df, path, "k", compression="lz4", ttl=60, now=1000.0) > 0
    assert kh.get_cached_dataframe(path, "k", columns=["id"], n_rows=7, now=1001.0).count() == 7
    assert kh.get_cached_dataframe(path, "k", now=2000.0) is None and kh.cache_ttl(path, "k", now=1010.0) == 50 and kh.cache_ttl(path, "zz") == -2
    kh.cache_dataframe(df, path, "j", format="ipc", compression="zstd")
    info = kh.cache_info(path, "j")
    assert info.format == "ipc" and info.size_bytes > 0 and info.ttl == -1 and kh.cache_exists(path, "j")
    assert kh.delete_cached(path, "j") and not kh.cache_exists(path, "j") and not kh.delete_cached(path, "j")
    with pytest.raises(ValueError):
        kh.cache_dataframe(df, path, "k", compression="brotli")
    calls = []

    @kh.cache(path, key_prefix="t")
    def made(n, scale=1):
        calls.append(n)
        return spark.range(n * scale)

    assert made(3).count() == made(3).count() == 3 and calls == [3]
    assert made(3, _cache_refresh=True).count() == 3 and made(3, _cache_skip=True).count() == 3 and calls == [3, 3, 3]
    assert made.is_cached(3) and made.invalidate(3) and not made.is_cached(3) and made.cache_key_for(3) != made.cache_key_for(3, scale=2)


def test_indexes(spark, path, users):
    catalog = kh.Catalog(f"{path}/catalog")
    index = kh.Index("users", "user:", [kh.TextField("name", sortable=True), kh.NumericField("age"), kh.TagField("active", separator=";")])
    assert str(index) == "users ON HASH PREFIX 1 user: SCHEMA name TEXT SORTABLE age NUMERIC active TAG SEPARATOR ;"
    catalog.create(index)
    with pytest.raises(ValueError):
        catalog.create(index)
    catalog.create(index, if_not_exists=True)
    changed = kh.Index("users", "user:", [kh.TextField("name"), kh.GeoField("at")])
    diff = catalog.diff(changed)
    assert (diff.added, diff.removed, list(diff.changed), diff.unchanged) == (["at"], ["age", "active"], ["name"], [])
    with pytest.raises(ValueError):
        catalog.migrate(changed)
    assert catalog.get("users") == index and catalog.info("users").prefixes == ["user:"] and [i.name for i in catalog.list_indexes()] == ["users"]
    assert catalog.find_index_for_pattern("user:1*").name == "users" and catalog.find_index_for_pattern("u*") is None
    query = kh.col("name").contains("user 7") & kh.col("active").iequals("TRUE")
    assert [r["_key"] for r in kh.smart_scan(users, "user:*", {"name": str, "active": str}, catalog=catalog, query=query, now=0.0).collect()] == ["user:7"]
    plan = kh.explain_scan(users, "user:*", {"name": str, "active": str}, catalog=catalog, query=query)
    assert plan.strategy is kh.ExecutionStrategy.HYBRID and "@name:user 7" in plan.explain()
    assert catalog.migrate(changed, drop_existing=True) and not catalog.migrate(changed, drop_existing=True)
    catalog.drop("users")
    with pytest.raises(IndexNotFound):
        catalog.get("users")
    assert kh.VectorField("v", algorithm="HNSW", dim=4, m=16).to_args() == ["v", "VECTOR", "HNSW", "8", "TYPE", "FLOAT32", "DIM", "4", "DISTANCE_METRIC", "COSINE", "M", "16"]
    made = kh.Index.from_frame("x", "x:", spark.createDataFrame([], "a int, s string, t string, b boolean, _h string, l array<int>"), text_fields=["t"])
    assert [(f.name, f.kind) for f in made.schema] == [("a", "NUMERIC"), ("s", "TAG"), ("t", "TEXT"), ("b", "TAG")]
    assert made.validate_schema({"a": int, "zz": str}) == ["zz"] and kh.Index.from_json(made.to_json()) == made


def test_key_listing(users, spark):
    assert kh.scan_keys(users, "user:4?", now=0.0).count() == 10 and kh.scan_keys(users, "*", 3, now=0.0).count() == 3
    scanner = kh.KeyScanner(users.drop("_expire_at"), "user:*", batch_size=20)
    assert [len(b) for b in scanner] == [20, 20, 10] and scanner.is_done and scanner.rows_yielded == 50
    info = kh.key_info({"hash": users}, "user:1", include_memory=True, now=0.0).first()
    assert info["key_type"] == "hash" and info["ttl"] == -1 and info["memory_usage"] > 10


def test_geo(spark, path):
    cities = [("New York", -74.006, 40.7128), ("Los Angeles", -118.2437, 34.0522), ("Chicago", -87.6298, 41.8781)]
    assert kh.geo_add(path, cities) == kh.GeoAddResult(3, 0) and kh.geo_add(path, [("Chicago", -87.63, 41.88)]) == kh.GeoAddResult(0, 1)
    places = kh.Table(path).read()
    assert kh.geo_dist(places, "New York", "Los Angeles") == pytest.approx(3936, abs=5) and kh.geo_dist(places, "New York", "x") is None
    assert [r["member"] for r in kh.geo_radius(places, -87.0, 41.0, 1500, sort="DESC").collect()] == ["New York", "Chicago"]
    near = kh.geo_radius_by_member(places, "Chicago", 800, "mi", count=2).collect()
    assert [r["member"] for r in near] == ["Chicago", "New York"] and near[0]["distance"] == 0
    assert {r["member"]: r["longitude"] for r in kh.geo_pos(places, ["Chicago", "x"]).collect()} == {"Chicago": -87.63, "x": None}
    matrix = {r["member"]: r for r in kh.geo_dist_matrix(places, ["New York", "Chicago"]).collect()}
    assert matrix["New York"]["New York"] == 0 and matrix["New York"]["Chicago"] == pytest.approx(matrix["Chicago"]["New York"])
    assert kh.geo_hash(spark.createDataFrame([("x", -5.6, 42.6)], "member string, lon double, lat double"), length=5).first()["geohash"] == "ezs42"


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_row_index_counts_every_row(spark, path, aqe):
    """Wide rows over many partitions: each number once, in the order of keys, for scans and for keys that a write makes."""
    n, held = 300_000, {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    rows = spark.range(n).select(F.format_string("k%09d", F.col("id")).alias("_key"), F.col("id").cast("string").alias("v"), F.repeat(F.lit("x"), 80).alias("w")).repartition(16, F.rand(3))
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        scanned = kh.scan_hashes(rows, "*", {"v": int, "w": str}, include_row_index=True, row_index_offset=7)
        assert tuple(scanned.agg(F.count(F.lit(1)), F.count_if(F.col("_index") == F.col("v") + 7)).first()) == (n, n)
        assert kh.write_hashes(rows.drop("_key"), path, key_column=None, key_prefix="r:") == n
        number = F.substring("_key", 3, 20).cast("long")
        assert tuple(kh.Table(path).read().agg(F.count(F.lit(1)), F.count_distinct(number), F.min(number), F.max(number), F.count_distinct("v")).first()) == (n, n, 0, n - 1, n)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_a_crash_between_rows_and_pointer_leaves_the_version_before(spark, path, monkeypatch):
    table = kh.Table(path)
    table.save(spark.range(3))

    def crash(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(kh.Table, "_pointed", crash)
    with pytest.raises(RuntimeError):
        table.save(spark.range(5))
    monkeypatch.undo()
    assert table.read().count() == 3
    table.save(spark.range(4))
    assert table.read().count() == 4 and table.latest()[0] == 2


def test_of_two_writers_none_is_lost(spark, path, monkeypatch):
    """The second one has read the table before the first one saves."""
    kh.write_hashes(spark.createDataFrame([("a", "1")], "_key string, v string"), path)
    first, other = kh.Table.latest, []

    def stale(self):
        found = first(self)
        if not other:
            other.append(True)
            other.append(kh.write_hashes(spark.createDataFrame([("b", "2")], "_key string, v string"), path))
        return found

    monkeypatch.setattr(kh.Table, "latest", stale)
    assert kh.write_hashes(spark.createDataFrame([("c", "3")], "_key string, v string"), path) == 1
    monkeypatch.undo()
    assert {r["_key"]: r["v"] for r in kh.Table(path).read().collect()} == {"a": "1", "b": "2", "c": "3"} and other[1] == 1
    table = kh.Table(path)
    with pytest.raises(VersionConflict):
        table.save(spark.range(1), after=1)
    assert table.vacuum(1) == 2 and table.read().count() == 3


def test_detailed_writes(spark, path):
    rows = spark.createDataFrame([("a", "x"), (None, "y"), ("b", "z")], "_key string, s string")
    out = kh.write_hashes_detailed(rows, path)
    assert (out.keys_written, out.keys_failed, out.is_complete_success, sorted(out.succeeded_keys)) == (2, 1, False, ["a", "b"]) and out.errors == {"": "1 rows have no key"}
    assert {r["_key"] for r in out.keys().collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        kh.Table("/")


def test_search_options(spark, users):
    mapped = spark.createDataFrame([("h:1", {"a": "5", "b": "x y"}, None), ("h:2", {"a": "7"}, 50.0), ("o:1", {"a": "9"}, None)], "_key string, fields map<string,string>, _expire_at double")
    rows = kh.search_hashes(mapped, kh.col("a") > 1, {"a": int, "b": str}, pattern="h:*", include_ttl=True, now=10.0, sort_by="a", include_row_index=True, row_index_offset=1).collect()
    assert [tuple(r) for r in rows] == [(1, "h:1", -1, 5, "x y"), (2, "h:2", 40, 7, None)]
    assert [tuple(r) for r in kh.search_hashes(mapped, kh.col("a") > 1, {"a": int, "nope": str}, now=60.0, include_key=False, n_rows=9).sort("a").collect()] == [(5, None), (9, None)]
    assert [f for f in kh.search_json(spark.createDataFrame([("j", '{"a": 1}')], "_key string, doc string"), "*", {"a": int}).columns] == ["_key", "a"]
    doc = spark.createDataFrame([("j", '{"in": {"n": 3, "s": "t"}, "n": 1}')], "_key string, doc string")
    assert tuple(kh.scan_json(doc, "*", {"n": int, "s": str}, options=kh.JsonScanOptions().with_path("$.in").with_projection(["n"])).first()) == ("j", 3)


def test_phrases_by_places(spark):
    from keyharbor.functions.text import has_phrase

    df = spark.createDataFrame([("a b c",), ("a x b y c",), ("b a",), ("a b",), ("a a",), ("x a y z a",), (None,), ("",)], "t string")
    found = lambda *w, **k: {r["t"] for r in df.where(has_phrase(F.col("t"), list(w), **k)).collect()}
    assert found("a", "b") == {"a b c", "a b"} and found("a b", "c", slop=2) == {"a b c", "a x b y c"} and found("a", "b", "c", slop=1) == {"a b c"}
    assert found("a", "a", in_order=False) == {"a a"} and found("a", "a", slop=2, in_order=False) == {"a a", "x a y z a"} and found("a", "b", in_order=False) == {"a b c", "b a", "a b"}
    assert found(*"abc", slop=9) == {"a b c", "a x b y c"} and found() == {r["t"] for r in df.collect()}
