import datetime as dt
import random

from quarry.operators import searches as sv

ITEMS = "url string, name string, description string, topics array<string>, stars int, language string, updated_at timestamp"
SEARCHES = "search_id long, min_stars int, language string, pushed_after timestamp, positive array<string>, negative array<string>"


def test_repeated_rows_and_many_terms_equal_a_scan(spark):
    r = random.Random(8)
    words = ["api", "web", "shop", "data", "zz", "a", "b c", "tool", "é"]
    items = [(r.choice(["u1", "u2", "u3", None]) or None, " ".join(r.sample(words, 2)), None, r.choice([None, [r.choice(words)]]), r.choice([None, 0, 5, 70]), r.choice([None, "Go", "py"]), r.choice([None, dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)])) for _ in range(60)] * 2
    searches = [(i % 30, r.choice([None, 3]), r.choice([None, "go"]), r.choice([None, dt.datetime(2022, 1, 1)]), r.sample(words, r.randint(0, 6)), r.sample(words, r.choice([0, 0, 1, 5]))) for i in range(40)]
    want = []
    for i, least, language, after, positive, negative in searches:
        for url, name, _, topics, stars, lang, updated in items:
            text = f"{name}  {' '.join(topics or [])}"
            if url and stars is not None and stars >= (least or 0) and (language is None or (lang or "").lower() == language) and (after is None or updated and updated > after) \
                    and (not positive or any(t in text for t in positive)) and not any(t in text for t in negative):
                want.append((i, url))
    got = sv.saved_searches(spark.createDataFrame(items, ITEMS), spark.createDataFrame(searches, SEARCHES))
    assert sorted((x.search_id, x.url) for x in got.collect()) == sorted(want) and len(want) > 200


def test_pairs_are_verified_without_their_texts(spark):
    items = spark.createDataFrame([("u1", "red bolt", None, ["Red"], 5, "Go", None), ("u2", "blue bolt", None, None, 9, None, None)], ITEMS)
    searches = spark.createDataFrame([(1, 0, "go", None, ["red", "bolt"], []), (2, 0, None, None, ["bolt"], ["red"])], SEARCHES)
    found = sv.saved_searches(items, searches)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" not in plan and "contains(text" not in plan.lower() and "exists(" not in plan and "speaks" in plan
    assert sorted((x.search_id, x.url) for x in found.collect()) == [(1, "u1"), (2, "u2")]
