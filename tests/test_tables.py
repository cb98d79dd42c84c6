"""Small hand-made inputs of the table operators, with answers worked out by hand."""

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.functions.text import tag_list, year_of
from rillstone.operators import documents, mapreduce, matrix, relational
from rillstone.operators.joins import with_every_row
from rillstone.plans import bikes, languages
from rillstone.sources import posts


def table(spark, schema, data):
    return spark.createDataFrame(data, schema)


def test_mean_of_filtered_groups(spark):
    users = table(
        spark, "id INT, age INT, contacts INT, gender STRING",
        [(0, 55, 20, "male"), (1, 25, 240, "female"), (2, 25, 500, "female"), (3, 33, 800, "female")],
    )
    got = relational.mean_by_group(users, F.col("gender") == "female", "age", "contacts", "mean")
    assert rows(got) == [(25, 370.0), (33, 800.0)]


def test_set_operations(spark):
    r = table(spark, "id INT, value INT", [(1, 10), (2, 25), (3, 5), (3, 5)])
    s = table(spark, "id INT, value INT", [(4, 30), (5, 15), (1, 10)])
    assert rows(relational.difference(r, s)) == [(2, 25), (3, 5)]
    assert rows(relational.intersection(r, s)) == [(1, 10)]
    assert rows(relational.union_distinct(r, s)) == [(1, 10), (2, 25), (3, 5), (4, 30), (5, 15)]
    assert relational.union_all(r, s).count() == 7
    assert rows(relational.selection(r, F.col("value") > 9)) == [(1, 10), (2, 25)]
    assert rows(relational.projection(r, ["value"])) == [(10,), (25,), (5,)]


def test_repeated_and_first(spark):
    items = table(spark, "id INT, value INT", [(1, 10), (2, 25), (3, 5), (4, 30), (5, 15), (6, 25), (7, 10)])
    assert rows(relational.repeated_values(items, "value"), "id") == [(1,), (2,), (6,), (7,)]
    keyed = table(spark, "key STRING, pos INT, value INT", [("A", 0, 10), ("B", 1, 25), ("A", 2, 15), ("C", 3, 40)])
    assert rows(relational.first_per_key(keyed, ["key"], ["pos"]), "key", "value") == [("A", 10), ("B", 25), ("C", 40)]


def test_natural_join_and_groups(spark):
    r = table(spark, "a INT, b INT", [(1, 10), (2, 20), (3, 30)])
    s = table(spark, "b INT, c INT", [(10, 100), (20, 200), (30, 300), (20, 250)])
    got = relational.natural_join(r, s).select("a", "b", "c")
    assert rows(got) == [(1, 10, 100), (2, 20, 200), (2, 20, 250), (3, 30, 300)]
    abc = table(spark, "a INT, b INT", [(1, 10), (1, 20), (2, 15), (2, 25), (1, 30)])
    assert rows(relational.group_aggregate(abc, ["a"], s=F.sum("b"), m=F.max("b"))) == [(1, 60, 30), (2, 40, 25)]
    assert rows(relational.total(abc, low=F.min("b"), mean=F.avg("b"))) == [(10, 20.0)]


def test_grouped_values_in_blocks(spark):
    data = [("A", 10), ("B", 25), ("A", 15), ("C", 40), ("B", 30), ("C", 5)]
    keyed = table(spark, "key STRING, value INT, id INT", [(k, v, i) for i, (k, v) in enumerate(data)])
    assert rows(relational.group_values(keyed, "key", "value", "id")) == [
        ("A", 0, [10, 15]), ("B", 0, [25, 30]), ("C", 0, [5, 40])
    ]
    blocks = rows(relational.group_values(keyed, "key", "value", "id", block_rows=1))
    assert blocks[:2] == [("A", 0, [10]), ("A", 1, [15])]


def test_keys_without_values_keep_an_empty_list(spark):
    keyed = table(spark, "key STRING, value INT, id INT", [("A", None, 1), ("A", None, 2), ("B", 3, 3), ("B", None, 4), (None, None, 5)])
    assert rows(relational.group_values(keyed, "key", "value", "id")) == [("A", 0, []), ("B", 0, [3]), (None, 0, [])]


def test_natural_join_needs_a_shared_column(spark):
    with pytest.raises(ValueError, match="shared"):
        relational.natural_join(table(spark, "a INT", [(1,)]), table(spark, "b INT", [(1,)]))


def test_farthest_stations_at_opposite_ends_of_the_earth(spark):
    places = [(1, "a", 10.0, -88.68), (2, "b", -10.0, 91.32), (3, "c", 0.0, 0.0), (4, "d", -170.0, 88.68)]
    found = bikes.farthest_stations(table(spark, "id INT, name STRING, lat DOUBLE, long DOUBLE", places[:3])).first()
    assert (found.station_a, found.station_b) == ("a", "b") and abs(found.km - 6371 * math.pi) < 1e-3
    pairs = [(10.0, -88.68, -170.0, 88.68), (-88.68, 10.0, 88.68, -170.0), (0.0, 0.0, 0.0, 180.0)]
    far = table(spark, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", pairs).select(geo.haversine_km(*map(F.col, "abcd")).alias("km"))
    assert not any(math.isnan(r.km) for r in far.collect())


def test_partitions_are_sorted(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"), "id")
    by_hash = relational.partition_sorted(df, "k", ["id"], 3)
    parts = by_hash.rdd.glom().collect()
    assert len(parts) == 3 and all(p == sorted(p, key=lambda r: (r["k"], r["id"])) for p in parts)
    by_range = [r["k"] for r in relational.range_sort(df, ["k", "id"], 4).collect()]
    assert by_range == sorted(by_range)


def test_increment(spark):
    assert rows(relational.increment(table(spark, "v BIGINT", [(1,), (10,), (-10,)]), "v")) == [(-9,), (11,), (2,)]


def test_word_count_keeps_empty_tokens(spark):
    lines = table(spark, "text STRING", [("",), ("it is what it is",), ("what is it",), ("it is a banana",)])
    counts = dict(rows(documents.word_count(lines)))
    assert counts == {"": 1, "it": 4, "is": 4, "what": 2, "a": 1, "banana": 1}


def test_inverted_index(spark):
    docs = table(spark, "doc_id INT, text STRING", [(0, "it is what it is"), (1, "what is it"), (10, "it is a banana"), (9, "a")])
    index = {r["word"]: r["doc_ids"] for r in documents.inverted_index(docs).collect()}
    assert index["it"] == ["0", "1", "10"] and index["a"] == ["10", "9"] and index["banana"] == ["10"]
    blocks = rows(documents.inverted_index(docs, block_rows=2).filter("word = 'it'"), "block", "doc_ids")
    assert blocks == [(0, ["0", "1"]), (1, ["10"])]


def test_matrix_products_match_numpy(spark):
    rng = np.random.default_rng(3)
    m, n = rng.integers(0, 5, (4, 6)).astype(float), rng.integers(0, 5, (6, 5)).astype(float)
    mr = table(spark, "i INT, j INT, v DOUBLE", [(i, j, float(m[i, j])) for i in range(4) for j in range(6) if m[i, j]])
    nr = table(spark, "j INT, k INT, w DOUBLE", [(j, k, float(n[j, k])) for j in range(6) for k in range(5)])
    for product in (matrix.matrix_product, matrix.matrix_product_in_memory):
        got = np.zeros((4, 5))
        for r in product(mr.unionByName(mr.limit(0)), nr).collect():
            got[r["i"], r["k"]] = r["value"]
        assert np.array_equal(got, m @ n)
    assert matrix.matrix_product_in_memory(mr, nr, limit=3).count() == matrix.matrix_product(mr, nr).count()
    a = table(spark, "i INT, j INT, v DOUBLE", [(0, 0, 2.0), (0, 1, 3.0), (1, 0, 4.0), (1, 1, 5.0), (2, 7, 1.0)])
    b = table(spark, "index INT, value DOUBLE", [(0, 1.0), (1, 2.0)])
    for times in (matrix.matrix_vector, matrix.matrix_vector_in_memory):
        assert rows(times(a, b)) == [(0, 8.0), (1, 14.0), (2, 0.0)]


def test_map_reduce_with_a_frequent_key(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))

    def add(pdf):
        return pdf.groupby("k", as_index=False)[["n"]].sum()

    got = mapreduce.map_reduce(
        df.repartition(6), lambda pdf: pd.DataFrame({"k": pdf["k"], "n": 1}), add, add, ["k"], "k STRING, n BIGINT", "k STRING, n BIGINT"
    )
    counts = dict(rows(got))
    assert counts["hot"] == 1333 and len(counts) == 668


def test_control_rows_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr("rillstone.operators.joins.BROADCAST_ROWS", 5)
    left, control = spark.range(7), spark.range(9).select(F.col("id").alias("n"))
    assert rows(with_every_row(left, control)) == sorted(((i, n) for i in range(7) for n in range(9)), key=repr)


def stations_brute(points):
    best = None
    for i, (ia, na, la, oa) in enumerate(points):
        for ib, nb, lb, ob in points[i + 1 :]:
            p, q = math.radians(la), math.radians(lb)
            h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(ob - oa) / 2) ** 2
            km = 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
            if best is None or km > best[0] + 1e-12:
                best = (km, {na, nb})
    return best


@pytest.mark.parametrize("case, few", [("city", 0), ("globe", 0), ("copies", 10**6)])
def test_farthest_stations_match_all_pairs(spark, case, few):
    rng = random.Random(case)
    make = {
        "city": lambda i: (37.3 + rng.random() * 0.5, -122.5 + rng.random() * 0.7),
        "globe": lambda i: (rng.uniform(-89, 89), rng.uniform(-180, 180)),
        "copies": lambda i: (40.0 + (i % 3 == 0) * rng.random(), -70.0),
    }[case]
    points = [(i, f"s{i}", *make(i)) for i in range(150)]
    got = bikes.farthest_stations(table(spark, "id INT, name STRING, lat DOUBLE, long DOUBLE", points), few).collect()
    km, names = stations_brute(points)
    assert len(got) == 1 and math.isclose(got[0]["km"], km, abs_tol=1e-6)
    if case != "copies":
        assert {got[0]["station_a"], got[0]["station_b"]} == names


def test_farthest_stations_needs_two_places(spark):
    one = table(spark, "id INT, name STRING, lat DOUBLE, long DOUBLE", [(1, "a", 1.0, 2.0), (2, "b", 1.0, 2.0)])
    assert bikes.farthest_stations(one).collect() == []


def test_posts_and_languages(spark):
    lines = table(
        spark, "value STRING",
        [
            ('<?xml version="1.0"?>',), ("<posts>",),
            ('  <row Id="1" CreationDate="2010-05-01T00:00:00.000" Tags="&lt;java&gt;&lt;C#&gt;" />',),
            ('  <row Id="2" CreationDate="2010-06-01T00:00:00.000" Tags="&lt;java&gt;" />',),
            ('  <row Id="3" Tags="&lt;java&gt;" />',), ('  <row Id="4" CreationDate="2010',),
            ('  <row Id="5" CreationDate="2011-06-01T00:00:00.000" />',), ("</posts>",),
        ],
    )
    parsed = posts.parse_posts(lines)
    assert rows(parsed, "Id") == [("1",), ("2",), ("3",), ("5",)]
    assert rows(parsed.filter("Id = 1"), "Tags") == [("<java><C#>",)]
    known = table(spark, "name STRING", [("Java",), ("Python",)])
    counts = languages.language_counts(posts.post_tags(parsed), known)
    assert rows(counts) == [(2010, "java", 2)]
    glued = languages.language_counts(posts.post_tags(parsed, "glued"), known)
    assert rows(glued) == [(2010, "java", 1)]
    many = table(spark, "Year INT, Language STRING, Count BIGINT", [(2010, f"l{i:02}", 5) for i in range(12)])
    top = languages.top_languages(many).orderBy("Rank").collect()
    assert [r["Language"] for r in top] == [f"l{i:02}" for i in range(10)] and top[-1]["Rank"] == 10
    bad = table(spark, "d STRING, t STRING", [("", "<a>")]).select(year_of(F.col("d")).alias("y"), tag_list(F.col("t")).alias("t"))
    assert rows(bad) == [(None, ["a"])]


def test_geo_values(spark):
    df = table(spark, "lon FLOAT, lat FLOAT", [(-73.9947, 40.750626), (0.0, 90.0), (float("nan"), 40.7), (-74.05, 41.0)])
    inside = [r[0] for r in df.select(geo.in_nyc(F.col("lon"), F.col("lat"))).collect()]
    assert inside[:3] == [True, False, False]
    got = df.limit(1).select(geo.cell_id(F.col("lon"), F.col("lat")).alias("c")).select(
        "c", geo.cell_center(F.col("c")).alias("p")
    ).first()
    assert got["c"] == 39 + 199 * 250
    assert abs(got["p"]["lon"] + 73.9947) < 0.0008 and abs(got["p"]["lat"] - 40.750626) < 0.0007
    geo.register_sql_functions(spark)
    df.createOrReplaceTempView("places")
    sql = spark.sql("SELECT toCellId(lon, lat) c, toCoords(toCellId(lon, lat)) p FROM places LIMIT 1").first()
    assert sql["c"] == got["c"] and sql["p"] == got["p"]
    diff = spark.sql("SELECT timeDiff(TIMESTAMP '2020-01-01 00:00:00', TIMESTAMP '2020-01-01 00:00:01') d").first()
    assert diff["d"] == 1000
    bucket = spark.sql("SELECT -1 AS d UNION ALL SELECT 359").select("d", geo.direction_bucket(F.col("d")))
    assert rows(bucket) == [(-1, 0), (359, 7)]


def meets_inside(x1, y1, x2, y2, cx, cy):
    """Whether the line between the middles of two cells has a point inside a third: its stretch within the cell is not empty."""
    low, high = Fraction(0), Fraction(1)
    for start, end, middle in ((x1, x2, cx), (y1, y2, cy)):
        near, far, step = middle - Fraction(1, 2), middle + Fraction(1, 2), end - start
        if step == 0:
            if not near < start < far:
                return False
            continue
        cuts = sorted(((near - start) / step, (far - start) / step))
        low, high = max(low, cuts[0]), min(high, cuts[1])
    return low < high or (x1, y1) == (x2, y2)


def test_cells_on_way(spark):
    rng = random.Random(5)
    ways = [tuple(rng.randrange(14) for _ in range(4)) for _ in range(150)] + [(3, 3, 3, 3), (0, 0, 9, 9), (0, 9, 9, 0), (2, 8, 2, 1), (0, 0, 3, 0)]
    df = spark.createDataFrame(ways, "x1 INT, y1 INT, x2 INT, y2 INT")
    for r in df.withColumn("cells", F.expr(geo.WAY_CELLS)).collect():
        way = (r.x1, r.y1, r.x2, r.y2)
        xs, ys = (range(min(p), max(p) + 1) for p in ((r.x1, r.x2), (r.y1, r.y2)))
        assert sorted(r.cells) == sorted(x + 250 * y for x in xs for y in ys if meets_inside(*way, x, y)), way
    geo.register_sql_functions(spark)
    df.createOrReplaceTempView("ways")
    counted = spark.sql("SELECT count(*) AS n FROM ways w, LATERAL cellsOnWay(w.x1, w.y1, w.x2, w.y2)").first().n
    assert counted == df.select(F.explode(F.expr(geo.WAY_CELLS))).count()
