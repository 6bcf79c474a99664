from pyspark.sql import functions as F

from feedloom.operators import graph as G


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "uid bigint, follower bigint")


def whole(rows, col):
    """uid -> its ids, over all of its chunks."""
    out = {}
    for r in rows.collect():
        out.setdefault(r["uid"], []).extend(r[col])
    return {u: sorted(v) for u, v in out.items()}


def test_follower_and_following_sets(spark):
    e = _edges(spark, [(1, 2), (1, 3), (1, 1), (2, 3), (1, 2)])
    users = spark.createDataFrame([(u,) for u in range(5)], "uid bigint")
    fl = whole(G.followers_lists(e), "followerslist")
    assert fl == {1: [2, 3], 2: [3]}                                   # set, self excluded
    fo = whole(G.following_lists(e, users), "followinglist")
    assert fo == {0: [], 1: [], 2: [1], 3: [1, 2], 4: []}
    # inverting twice gives the follower sets back
    inv = G.following_lists(e, users).select("uid", F.explode("followinglist").alias("followee"))
    back = inv.select(F.col("followee").alias("uid"), F.col("uid").alias("follower"))
    assert whole(G.followers_lists(back), "followerslist") == fl
    fc = {r["uid"]: r["n_following"] for r in G.following_counts(e, users).collect()}
    assert fc == {0: 0, 1: 0, 2: 1, 3: 2, 4: 0}
    assert tuple(G.graph_totals(e).first()) == (3, 2, 2)


def test_chunked_sets_bound_group_size(spark):
    e = _edges(spark, [(7777, f) for f in range(1, 101)])
    # ids with one residue do not meet in one chunk
    chunks = G.followers_lists(e.withColumn("follower", F.col("follower") * 10), chunks=10).collect()
    assert len(chunks) == 10 and max(len(r["followerslist"]) for r in chunks) <= 25
    assert [10 * x for x in range(1, 101)] == sorted(x for r in chunks for x in r["followerslist"])
    chunks = G.followers_lists(e, chunks=3).collect()
    assert len(chunks) == 3
    assert sorted(x for r in chunks for x in r["followerslist"]) == list(range(1, 101))


def test_tier_table_bounds():
    t = {name: (cut, lo, hi) for name, cut, lo, hi in G.tier_table(100_000)}
    assert t["t1"] == (50.0, 6001, 13999)
    assert t["t5"] == (10500.0, 101, 299)
    assert t["t8"] == (None, 5, 5)


def test_audience_tiers(spark):
    users = spark.createDataFrame([(u,) for u in range(2000)], "uid bigint")
    counts = spark.createDataFrame([(0, 150), (1999, 5)], "uid bigint, n_followers bigint")
    per = {r["uid"]: r for r in G.audience_tiers(users, counts, 2000).collect()}
    assert per[0]["tier"] == "t1" and per[1999]["tier"] == "t8" and per[1999]["n_followers"] == 5
    summary = {r["tier"]: r for r in G.tier_summary(G.audience_tiers(users, counts, 2000)).collect()}
    assert summary["t8"]["n_in_bounds"] == 1


def test_large_sets_lie_in_more_chunks(spark):
    edges = spark.range(1, 2001).select(F.lit(1).cast("long").alias("uid"), F.col("id").alias("follower")) \
        .unionByName(spark.createDataFrame([(2, 5), (2, 6), (2, 6)], "uid bigint, follower bigint"))
    lists = G.followers_lists(edges, chunks=4, chunk_ids=50)
    got = {u: lists.filter(F.col("uid") == u).collect() for u in (1, 2)}
    assert {r["chunks"] for r in got[1]} == {40} and {r["chunks"] for r in got[2]} == {4}
    assert sorted(i for r in got[1] for i in r["followerslist"]) == list(range(2, 2001))     # self excluded
    assert max(len(r["followerslist"]) for r in got[1]) < 110 and len(got[1]) == 40
    assert sorted(i for r in got[2] for i in r["followerslist"]) == [5, 6]
    users = spark.createDataFrame([(9999,), (5,)], "uid bigint")
    back = {(r["uid"], tuple(r["followinglist"])) for r in G.following_lists(edges, users, chunks=1, chunk_ids=50).collect()}
    assert (9999, ()) in back and (5, (1, 2)) in back
