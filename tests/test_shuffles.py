"""What the log queries move: numbers once, not texts."""

import re

from forktide.operators import compare, merge
from forktide.queries import QUERIES, SQL, fx

SF_DIR = "/root/testdata/sf0.001"


def dealt(spark, name):
    """The keys by which the query's plan deals rows out (AQE's first plan)."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hash|range)partitioning\((.*?), \d+\), (\w+)", plan)


def test_the_view_of_logs_is_its_sql(spark):
    want = spark.sql(fx.LOGS.replace(" FROM lineitem", " FROM {lineitem}"), lineitem=spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    got = fx.logs(spark, SF_DIR)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 6000


def test_multisets_are_compared_without_moving_texts(spark):
    assert {keys.split("#")[0] for keys, _ in dealt(spark, "q20_log_multiset_diff")} == {"l_orderkey"}
    a = spark.createDataFrame([(1, "x", None), (1, None, "x"), (2, "y", "z"), (2, "y", "z")], "n int, p string, q string")
    b = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, "y", "z"), (3, "y", "z")], "n int, p string, q string")
    for place in (None, "n"):
        assert tuple(compare.multiset_difference(a, b, place).first()) == (2, 2, False) and tuple(compare.multiset_difference(a, a, place).first()) == (0, 0, True)


def test_canonical_logs_are_sorted_before_their_texts_are_made(spark):
    found = dealt(spark, "q01_canonical_logs")
    assert not any("hash" in keys for keys, _ in found)
    df = QUERIES["q01_canonical_logs"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("concat(x:") < plan.index("Exchange rangepartitioning") < plan.rindex("concat(c:")  # above it
    places = [(r["block_number"], r["transaction_index"], r["log_index"]) for r in df.collect()]
    assert places == sorted(places) and len(places) == 6000


def test_payloads_and_merges_do_not_deal_logs_by_texts(spark):
    for name in ("q40_payload_with_logs", "q37_log_merge_whole"):
        assert {keys.split("#")[0] for keys, _ in dealt(spark, name)} <= {"l_orderkey", "height"}, name


def test_a_merge_keeps_what_only_one_side_has_and_nulls_in_place(spark):
    schema = "block_number long, block_hash string, log_index int, topic0 string, topic1 string, data string, decoded_event string, decoder_version string"
    old = [(1, "a", 0, "t", None, "d", "e1", "v1"), (1, "a", 1, "t", None, "d", "e1", "v1"), (1, "a", 2, "t", "u", "d", "e1", "v1"), (2, "b", 0, "t", "u", "d", None, None)]
    new = [(1, "a", 0, "t", None, "d", "e2", "v2"), (1, "a", 1, None, "t", "d", "e2", "v2"), (1, "a", 2, "t", "u", "d", None, None), (3, "c", 0, "t", "u", "d", "e2", "v2")]
    got = merge.merge_logs(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select(*reversed(schema.replace(" long", "").replace(" string", "").replace(" int", "").split(", "))))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1:3]) == [(1, "a", 0, "t", None, "d", "e2", "v2"), *old[1:], new[3]]


def test_differing_buckets_are_found_in_one_pass(spark):
    a = spark.createDataFrame([(1, "x", None), (70, "y", "z"), (70, "y", "z"), (200, "w", "w")], "n long, p string, q string")
    b = spark.createDataFrame([(1, None, "x"), (70, "y", "z"), (200, "w", "w"), (300, "n", "n")], "n long, p string, q string")
    assert sorted(r[0] for r in compare.differing_buckets(a, b, 64, "n", ["n", "p", "q"]).collect()) == [0, 1, 4]
    assert sorted((r["n"], r["only_a"], r["only_b"]) for r in compare.differences(a, b, "n", ["n", "p", "q"]).collect()) == [(1, 0, 1), (1, 1, 0), (70, 1, 0), (300, 0, 1)]
    plan = QUERIES["q47_range_digest_diff"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 12  # one level of digests, which meets three parts


def test_the_code_of_the_bundled_events_is_compiled(spark):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = QUERIES["q41_decode_bundled_events"](spark, SF_DIR)._jdf.queryExecution()
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", spark._jvm.PythonSQLUtils.explainString(found, "codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(map(int, sizes)) < 8000


def test_bundled_events_of_nought_are_their_sql(spark, tmp_path):
    import duckdb

    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").where("l_orderkey < 40").selectExpr("* EXCEPT (l_quantity)", "0.0D AS l_quantity").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = c.execute(f"SELECT block_hash, log_index, status, event, args FROM ({SQL['q41_decode_bundled_events']})").fetchall()
    assert sorted(map(tuple, QUERIES["q41_decode_bundled_events"](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str) and want
