"""Saved searches (F6, F7, L4) and filter documents (F15, K9, A15) against evaluation row by row."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators.filterdocs import compile_filter, find, find_all, find_table
from quarry.operators.searches import saved_searches

ITEMS = "url string, name string, description string, topics array<string>, stars int, language string, updated_at timestamp"


def test_searches_equal_a_scan_for_each(spark):
    import datetime as dt

    r = random.Random(4)
    word = lambda: r.choice(["api", "Web", "ab", "x", "shop tool", "ééé", "data", "zz", "a%b", "."])
    items = [(f"u{i % 190}", word() + word(), r.choice([None, word() + " " + word()]), r.choice([None, [], [word(), word()]]), r.choice([None, 0, 5, 70, 900]), r.choice([None, "Go", "go", "Py"]), dt.datetime(2020 + i % 5, 1, 1)) for i in range(200)]
    searches = [(i, r.choice([None, 0, 10, 80]), r.choice([None, None, "GO", "rust"]), r.choice([None, dt.datetime(2022, 6, 1)]),
                 r.choice([None, [], [""], [word()], [word(), word(), None], ["nowhere"], ["API"], ["e"], ["b"]]), r.choice([None, [], [word()], [""]])) for i in range(150)]
    got = saved_searches(spark.createDataFrame(items, ITEMS), spark.createDataFrame(searches, "search_id long, min_stars int, language string, pushed_after timestamp, positive array<string>, negative array<string>"))
    want = set()
    for i, least, language, after, positive, negative in searches:
        terms, never = ([t.lower() for t in x or [] if t] for x in (positive, negative))
        for url, name, description, topics, stars, lang, updated in items:
            text = " ".join([name, description or "", " ".join(topics or [])]).lower()
            if stars is not None and stars >= (least or 0) and (language is None or (lang or "").lower() == language.lower()) and (after is None or updated > after) \
                    and (not terms or any(t in text for t in terms)) and not any(t in text for t in never):
                want.add((i, url))
    assert {tuple(x) for x in got.distinct().collect()} == want and len(want) > 500
    assert saved_searches(spark.createDataFrame([], ITEMS), spark.createDataFrame(searches[:3], "search_id long, min_stars int, language string, pushed_after timestamp, positive array<string>, negative array<string>")).count() == 0


def meets(value, op, asked):
    kinds = lambda a, b: type(a) is type(b) or {type(a), type(b)} <= {int, float}
    if op == "$ne":
        return not meets(value, "$eq", asked)
    if op == "$nin":
        return not meets(value, "$in", asked)
    if op == "$not":
        return not all(meets(value, o, x) for o, x in asked.items())
    if op == "$exists":
        return (value is not None) == bool(asked)
    if op == "$size":
        return isinstance(value, list) and len(value) == asked
    if op == "$all":
        return bool(asked) and all(meets(value, "$eq", x) for x in asked)
    if op == "$in":
        return any(meets(value, "$eq", x) for x in asked)
    if isinstance(value, list) and not isinstance(asked, list):
        return any(meets(x, op, asked) for x in value)
    if op == "$regex":
        return isinstance(value, str) and re.search(asked, value) is not None
    if value is None or asked is None:
        return value is None and asked is None and op in ("$eq", "$gte", "$lte")
    if not kinds(value, asked):
        return False
    return {"$eq": value == asked, "$gt": op == "$gt" and value > asked, "$gte": op == "$gte" and value >= asked, "$lt": op == "$lt" and value < asked, "$lte": op == "$lte" and value <= asked}[op]


def evaluate(document, row):
    out = True
    for name, asked in document.items():
        if name in ("$and", "$or", "$nor"):
            inner = [evaluate(d, row) for d in asked]
            out &= all(inner) if name == "$and" else any(inner) if name == "$or" else not any(inner)
            continue
        value = row
        for part in name.split("."):
            value = value.get(part) if isinstance(value, dict) else None
        if not (isinstance(asked, dict) and any(k.startswith("$") for k in asked)):
            asked = {"$eq": asked}
        out &= all(meets(value, op, x) for op, x in asked.items())
    return out


def some_document(r, depth=2):
    if depth and r.random() < 0.4:
        return {r.choice(["$and", "$or", "$nor"]): [some_document(r, depth - 1) for _ in range(r.randint(1, 3))]}
    field = r.choice(["n", "s", "flag", "tags", "in.k", "in.none", "missing", "x"])
    value = lambda: r.choice([None, 0, 1, 2.5, "a", "b", "", True])
    op = r.choice(["$eq", "$ne", "$gt", "$gte", "$lt", "$lte", "$in", "$nin", "$exists", "$regex", "$not", "$size", "$all", None])
    asked = {None: value, "$in": lambda: [value(), value()], "$nin": lambda: [value()], "$exists": lambda: r.choice([True, False]), "$regex": lambda: r.choice(["^a", "b|c", "."]),
             "$not": lambda: {"$gt": value()}, "$size": lambda: r.randint(0, 2), "$all": lambda: r.choice([["a"], ["a", "b"]])}.get(op, value)()
    return {field: asked if op is None else {op: asked}}


def test_documents_equal_evaluation_row_by_row(spark):
    r = random.Random(9)
    rows = [(i, r.choice([None, 0, 1, 2]), r.choice([None, "", "a", "ab", "b"]), r.choice([None, True, False]), r.choice([None, [], ["a"], ["a", "b"], [None]]), r.choice([None, (1,), (None,)]), r.choice([None, 2.5, 1.0])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, n int, s string, flag boolean, tags array<string>, `in` struct<k:int>, x double")
    documents = [some_document(r) for _ in range(240)] + [{}, {"n": {"$gte": 1, "$lt": 2}, "s": {"$in": ["a", None]}}]
    got = {(x.filter_id, x.id) for x in find_all(df, list(enumerate(documents))).select("filter_id", "id").collect()}
    dicts = [{"id": i, "n": n, "s": s, "flag": f, "tags": t, "in": None if k is None else {"k": k[0]}, "x": x} for i, n, s, f, t, k, x in rows]
    want = {(k, row["id"]) for k, d in enumerate(documents) for row in dicts if evaluate(d, row)}
    wrong = {k for k, _ in got ^ want}
    assert not wrong, [documents[k] for k in sorted(wrong)[:5]]


def test_tables_of_filters(spark):
    df = spark.createDataFrame([(1, "Go"), (5, None), (9, "Py")], "stars int, language string")
    filters = spark.createDataFrame([(7, '{"stars": {"$gt": 4}}'), (8, '{"language": null}'), (9, '{"language": {"$regex": "^g", "$options": "i"}}')], "filter_id long, document string")
    assert sorted((x.filter_id, x.stars) for x in find_table(df, filters).collect()) == [(7, 5), (7, 9), (8, 5), (9, 1)]
    assert find(df, {"stars": 5}).count() == 1 and find_all(df, []).count() == 0
    plan = find(spark.read.parquet("/root/testdata/sf0.001/part.parquet"), {"p_size": {"$gt": 40}, "p_type": {"$ne": "SMALL"}})._jdf.queryExecution().toString()
    assert "GreaterThan(p_size,40)" in plan                                 # among the scan's pushed filters
    many = [(i, {"stars": {"$gte": i % 12}}) for i in range(1000)]
    counts = {r.filter_id: r["count"] for r in find_all(df, many).groupBy("filter_id").count().collect()}
    assert counts == {i: sum(s >= i % 12 for s in (1, 5, 9)) for i in range(1000) if i % 12 <= 9}
    with pytest.raises(ValueError):
        compile_filter({"a": {"$near": 1}}, df.schema)
    assert df.filter(F.lit(True) & compile_filter({}, df.schema)).count() == 3


def test_a_table_of_documents_equals_evaluation(spark):
    r = random.Random(11)
    rows = [(i, r.choice([None, *range(12)]), r.choice([None, "Go", "go", "Py", ""]), r.choice([None, ["a"], ["b", "x"], []]), r.choice([None, 0.5, 2.0])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, n int, s string, tags array<string>, x double")
    kinds = [lambda: {"n": {"$gte": r.randint(-3, 9), "$lt": r.randint(0, 40)}, "$or": [{"s": r.choice([None, "Go"])}, {"tags": {"$in": ["a", "x"]}}]},
             lambda: {"n": r.randint(0, 12)}, lambda: {"n": {"$gt": r.randint(0, 9), "$lte": r.randint(0, 9)}}, lambda: {"x": {"$gt": r.choice([0, 0.5, 1.5])}},
             lambda: {"s": {"$nin": ["Go", None]}}, lambda: {"n": {"$not": {"$gte": r.randint(0, 12)}}, "s": {"$ne": "Py"}}, lambda: {}, lambda: {"n": "Go"}]
    documents = [r.choice(kinds)() for _ in range(120)]
    table = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "filter_id long, document string")
    got = sorted((x.filter_id, x.id) for x in find_table(df, table).select("filter_id", "id").collect())
    names = ("id", "n", "s", "tags", "x")
    assert got == sorted((k, row[0]) for k, d in enumerate(documents) for row in rows if evaluate(d, dict(zip(names, row))))


def test_tables_of_more_filters_than_one_pass_takes(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "n int")
    filters = spark.range(10_050).selectExpr("id AS filter_id", """concat('{"n": {"$gte": ', id % 60, ', "$lt": ', id % 60 + 2, '}}') AS document""")
    assert find_table(df, filters).count() == sum(min(i % 60 + 2, 50) - min(i % 60, 50) for i in range(10_050))


def test_found_pairs_are_not_shuffled(spark):
    items = spark.createDataFrame([("u1", "red bolt", None, ["Red"], 5, "Go", None), ("u1", "blue", None, None, 9, None, None), (None, "red", None, None, 9, "go", None)],
                                  "url string, name string, description string, topics array<string>, stars int, language string, updated_at timestamp")
    searches = spark.createDataFrame([(1, 0, None, None, ["red", "bolt", "red"], []), (2, 0, "GO", None, [], []), (3, 6, None, None, [], ["red"]), (None, 0, None, None, [], [])],
                                     "search_id long, min_stars int, language string, pushed_after timestamp, positive array<string>, negative array<string>")
    found = saved_searches(items, searches)
    top = found._jdf.queryExecution().optimizedPlan().toString()
    assert top.startswith("Union") and "Aggregate [search_id" not in top
    assert sorted((r.search_id, r.url) for r in found.collect()) == [(1, "u1"), (2, "u1"), (3, "u1")]
