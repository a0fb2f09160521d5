import random

from quarry.operators import docs as dc
from test_trees_code import brute_review_tree

SCHEMA = "repo_id long, file_no int, path string, content string"


def test_render_tree_cut_anywhere_matches_brute_force(spark):
    rng = random.Random(11)
    names = ["a", "B", "b", "lib", "x.py", "Z", "dist"]
    repos = {}
    for r in range(40):
        paths = {"/".join(rng.choice(names) for _ in range(rng.randint(1, 5))) + f"{rng.randint(0, 3)}.py" for _ in range(rng.randint(1, 25))}
        repos[r] = sorted(p for p in paths if not any(q.startswith(p + "/") for q in paths))
    files = spark.createDataFrame([(r, i, p, "") for r, ps in repos.items() for i, p in enumerate(ps)] + [(None, 1, "gone.py", ""), (99, 1, None, "")], SCHEMA)
    for depth, cap in ((3, 1), (3, 4), (0, 3), (1, 9), (4, 17)):
        got = {r["repo_id"]: r["tree"] for r in dc.render_tree(files, max_depth=depth, max_lines=cap).collect()}
        assert got == {r: t for r, ps in repos.items() if (t := brute_review_tree(ps, depth, cap))}, (depth, cap)


def test_render_tree_shuffles_paths_once(spark):
    files = spark.createDataFrame([(1, 1, "a/b.py", ""), (1, 2, "c.md", "")], SCHEMA)
    tree = dc.render_tree(files)
    tree.collect()
    plan = tree._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1 and "BroadcastExchange" not in plan
