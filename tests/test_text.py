from pyspark.sql import functions as F

from quarry.functions import text as tx


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_owner_repo_literal_cases(spark):
    cases = {
        "https://github.com/pytorch/pytorch": ("pytorch", "pytorch"),
        "https://github.com/user/repo/.github/workflows": ("user", "repo"),
        "https://github.com/user/repo.git?branch=main": ("user", "repo"),
        "git@github.com:user/repo.git": ("user", "repo"),
        "https://github.com/user/repo/#readme": ("user", "repo"),
    }
    for url, want in cases.items():
        r = one(spark, tx.owner_repo, url)
        assert (r["owner"], r["repo"]) == want, url
        assert r["error"] is None
    bad = one(spark, tx.owner_repo, "https://gitlab.com/user/repo")
    assert bad["owner"] is None and bad["error"] == "invalid url"
    short = one(spark, tx.owner_repo, "https://github.com/user")
    assert short["owner"] is None and short["error"] == "cannot extract owner and name"


def test_owner_repo_git_strip_modes(spark):
    url = "https://github.com/x/y.github.io"
    assert one(spark, tx.owner_repo, url)["repo"] == "y.github.io"
    assert one(spark, lambda c: tx.owner_repo(c, legacy_git_strip=True), url)["repo"] == "yhub.io"


def test_valid_url_null_and_empty(spark):
    assert one(spark, tx.valid_github_url, None) is False
    assert one(spark, tx.valid_github_url, "") is False
    assert one(spark, tx.valid_github_url, "http://github.com/a/b") is True


def test_flatten_literal(spark):
    df = spark.createDataFrame([([[1, 2], [3, 4], [5]],)], "v array<array<int>>")
    assert df.select(F.flatten("v")).first()[0] == [1, 2, 3, 4, 5]


def test_truncate_variants(spark):
    assert one(spark, lambda c: tx.truncate(c, 5), "abcdef") == "ab..."
    assert one(spark, lambda c: tx.truncate(c, 6), "abcdef") == "abcdef"
    assert one(spark, lambda c: tx.truncate_rstrip(c, 8), "abc   defgh") == "abc..."
    assert one(spark, tx.approx_tokens, "abcdefg") == 1


def test_readme_type_cascade(spark):
    assert one(spark, tx.readme_type, "A REST endpoint and a web UI") == "api"
    assert one(spark, tx.readme_type, "React frontend") == "web_application"
    assert one(spark, tx.readme_type, "a command line tool") == "cli_tool"
    assert one(spark, tx.readme_type, "Nothing matches here") == "other"
    assert one(spark, tx.readme_type, "An Android game") == "mobile_app"


def test_path_excluded_substring_and_segment(spark):
    assert one(spark, tx.path_excluded, ".gitignore") is True
    assert one(spark, tx.path_excluded, ".github/workflows/ci.yml") is True
    assert one(spark, tx.path_excluded, "src/app.py") is False
    assert one(spark, lambda c: tx.path_excluded(c, by_segment=True), ".gitignore") is False
    assert one(spark, lambda c: tx.path_excluded(c, by_segment=True), "a/node_modules/x.js") is True


def test_safe_file_name(spark):
    assert one(spark, tx.safe_file_name, "https://github.com/Own er/re:po.git") == "Owner_repo.json"
    assert one(spark, tx.safe_file_name, "plain") == "unknown_plain.json"
