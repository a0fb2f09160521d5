import json
import random

from pyspark.sql import functions as F

from quarry.operators import filterdocs as fd
from quarry.plans import discovery_plans as dp

ITEMS = "url string, stars int, language string, description string, topics array<string>, score double"


def some_items(rng, n=120):
    pick = rng.choice
    return [(pick([None, f"u{rng.randint(0, 90)}"]), pick([None, *range(12)]), pick([None, "Go", "C"]), pick([None, "", "words " + str(rng.random())]),
             pick([None, [], ["web"], ["web", "k8s", "web"], ["other" + str(rng.random())], [None, "cli"]]), pick([None, 0.5, -0.0])) for _ in range(n)]


DOCUMENTS = [{"stars": {"$gte": 2, "$lt": 6}, "$or": [{"language": "Go"}, {"topics": {"$in": ["web", "k8s"]}, "description": {"$ne": None}}]},
             {"stars": {"$gte": 0, "$lt": 9}, "$or": [{"language": None}, {"topics": {"$in": ["cli"]}, "description": {"$ne": None}}]},
             {"stars": {"$gte": 9, "$lt": 2}, "$or": [{"language": None}, {"topics": {"$in": ["cli"]}, "description": {"$ne": None}}]},
             {"topics": {"$nin": ["k8s", "gone"]}, "description": {"$exists": True}}, {"language": {"$not": {"$in": ["C"]}}}, {}]


def test_rows_alike_are_asked_for_alike(spark):
    rng = random.Random(2)
    items = spark.createDataFrame(some_items(rng), ITEMS)
    filters = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCUMENTS)], "filter_id long, document string")
    cut = fd.cut_filters(filters)
    asked = fd.as_asked(items, cut)
    reduced = items.select("url", *asked)
    assert set(reduced.columns) == {"url", "stars", "language", "description", "topics"}
    assert reduced.select("description").distinct().count() == 2                  # null or not is all that is asked
    assert {tuple(r[0]) for r in reduced.select("topics").distinct().collect() if r[0] is not None} == {(), ("web",), ("k8s", "web"), ("cli",)}

    def rows(found):
        return sorted((r["filter_id"], r["url"] or "") for r in found.select("filter_id", "url").collect())

    want = rows(fd.find_all(items, list(enumerate(DOCUMENTS))))
    for few in (False, True):
        assert rows(fd.find_table(reduced, cut, few=few)) == want
    for name in ("topics", "description"):                                       # conditions that read more keep more
        other = spark.createDataFrame([(0, json.dumps({name: {"$regex": "w"}})), (1, json.dumps({"topics": {"$size": 2}}))], "filter_id long, document string")
        assert items.select(*fd.as_asked(items, fd.cut_filters(other))).select(name).distinct().count() == items.select(name).distinct().count()


def test_filter_table_counts_items_that_are_alike_together(spark, monkeypatch):
    rng = random.Random(5)
    items = spark.createDataFrame(some_items(rng, 1500), ITEMS)
    documents = [(i, json.dumps({"stars": {"$gte": i % 9, "$lt": i % 9 + 4}, "$or": [{"language": ["Go", "C", None][i % 3]}, {"topics": {"$in": ["web", "k8s"]}, "description": {"$ne": None}}]})) for i in range(30)]
    filters = spark.createDataFrame(documents, "filter_id long, document string")
    monkeypatch.setattr(dp, "fixture", lambda spark, sf, name: {"v_search_items": items, "v_filters": filters}[name])
    met, find = [], dp.find_table
    monkeypatch.setattr(dp, "find_table", lambda df, *a, **k: (met.append(df.count()), find(df, *a, **k))[1])
    got = {r["filter_id"]: (r["n"], r["first_url"]) for r in dp.q_filter_table(spark, "").collect()}
    found = fd.find_all(items, [(i, json.loads(d)) for i, d in documents]).groupBy("filter_id").agg(F.count("*").alias("n"), F.min("url").alias("u"))
    assert got == {r["filter_id"]: (r["n"], r["u"]) for r in found.collect()}
    assert met[0] <= 13 * 3 * 2 * 4                                              # of 1500 items: stars, language, whether described, what is asked of topics
    none = filters.limit(0)
    monkeypatch.setattr(dp, "fixture", lambda spark, sf, name: {"v_search_items": items, "v_filters": none}[name])
    assert dp.q_filter_table(spark, "").collect() == []
