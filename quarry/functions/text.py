"""Column-level string helpers (pure Catalyst expressions, codegen friendly).

Python's ``str`` methods are Unicode aware; Java regexes are not unless
``(?U)`` is set, so every whitespace/word class here carries that flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the characters Python's ``str.isspace()`` accepts (what ``str.strip()`` removes).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                 "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def ustrip(c: ColumnOrName) -> Column:
    """``str.strip()``: drop Python whitespace at both ends (a character-set trim, no regex)."""
    return F.trim(col(c), F.lit(PY_WHITESPACE))


def urstrip(c: ColumnOrName) -> Column:
    """``str.rstrip()``."""
    return F.rtrim(col(c), F.lit(PY_WHITESPACE))


def truthy(c: ColumnOrName) -> Column:
    """Python truthiness of a string: not null and not empty."""
    c = col(c)
    return c.isNotNull() & (F.length(c) > 0)


def or_default(c: ColumnOrName, default) -> Column:
    """``x or default`` for strings: null and '' both fall back."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default) if not isinstance(default, Column) else default)


def contains_any(c: ColumnOrName, words) -> Column:
    """Substring test against a word list (one ``OR`` of ``contains``, codegen'd)."""
    c = col(c)
    out = None
    for w in words:
        t = c.contains(w)
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def first_match(c: Column, rules, default=None) -> Column:
    """Ordered cascade: first rule whose substring list matches ``c`` gives the label."""
    expr = None
    for label, words in rules:
        cond = contains_any(c, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def approx_tokens(c: ColumnOrName) -> Column:
    """``len(text) // 4``."""
    return F.floor(F.length(col(c)) / 4).cast("long")


def truncate(c: ColumnOrName, max_length: int = 100, suffix: str = "...") -> Column:
    """``text[:max-len(suffix)] + suffix`` when longer than ``max``."""
    c = col(c)
    keep = max(max_length - len(suffix), 0)
    return F.when(F.length(c) <= max_length, c).otherwise(
        F.concat(F.substring(c, 1, keep), F.lit(suffix)))


def truncate_rstrip(c: ColumnOrName, max_length: int = 600) -> Column:
    """P3 variant: ``s[:max-3].rstrip() + '...'`` when longer than ``max``."""
    c = col(c)
    cut = urstrip(F.substring(c, 1, max_length - 3))
    return F.when(F.length(c) <= max_length, c).otherwise(F.concat(cut, F.lit("...")))


# The README project-type cascade (substrings of the lower-cased text).
README_TYPE_RULES = [
    ("api", ["api", "rest", "endpoint"]),
    ("web_application", ["web", "frontend", "react"]),
    ("cli_tool", ["cli", "command", "tool"]),
    ("library", ["library", "package", "sdk"]),
    ("framework", ["framework"]),
    ("mobile_app", ["mobile", "ios", "android"]),
]


def readme_type(readme: ColumnOrName) -> Column:
    """Project type from README text by ordered substring cascade."""
    return first_match(F.lower(col(readme)), README_TYPE_RULES, "other")


# URL prefixes accepted as repository URLs.
GITHUB_PREFIXES = ["https://github.com/", "http://github.com/", "git@github.com:"]


def valid_github_url(url: ColumnOrName) -> Column:
    """null/'' -> false; else starts with one of the accepted prefixes."""
    u = col(url)
    test = None
    for p in GITHUB_PREFIXES:
        t = u.startswith(p)
        test = t if test is None else (test | t)
    return F.coalesce(test, F.lit(False))


def owner_repo(url: ColumnOrName, legacy_git_strip: bool = False) -> Column:
    """struct(owner, repo, error) from a repository URL.

    Strip trailing '/', cut at '?' then '#', drop '.git' (suffix only, or
    everywhere when ``legacy_git_strip``), take the first two non-empty path
    segments after the host. Invalid input gives null owner/repo and an error.
    """
    u = col(url)
    s = F.regexp_replace(u, "/+$", "")
    s = F.substring_index(s, "?", 1)
    s = F.substring_index(s, "#", 1)
    s = F.regexp_replace(s, r"\.git", "") if legacy_git_strip else F.regexp_replace(s, r"\.git$", "")
    path = F.when(s.startswith("git@github.com:"), F.substring(s, len("git@github.com:") + 1, 1 << 30)) \
        .otherwise(F.when(s.contains("github.com/"), F.try_element_at(F.split(s, "github\\.com/", -1), F.lit(2))))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    ok = valid_github_url(u) & (F.size(parts) >= 2)
    return F.struct(
        F.when(ok, parts[0]).alias("owner"),
        F.when(ok, parts[1]).alias("repo"),
        F.when(~valid_github_url(u), F.lit("invalid url"))
         .when(~ok, F.lit("cannot extract owner and name")).alias("error"),
    )


# Path fragments excluded from file trees (substring test on the whole path).
EXCLUDED_PATH_PARTS = [".git", "node_modules", "__pycache__", ".venv", "venv", ".pytest_cache", ".mypy_cache"]


def path_excluded(path: ColumnOrName, by_segment: bool = False) -> Column:
    """P5: true when any excluded fragment occurs in the path."""
    p = col(path)
    if by_segment:
        segs = F.split(p, "/")
        return F.arrays_overlap(segs, F.array(*[F.lit(x) for x in EXCLUDED_PATH_PARTS]))
    return contains_any(p, EXCLUDED_PATH_PARTS)


def safe_file_name(repo_url: ColumnOrName) -> Column:
    """K3: ``{owner}_{repo}.json`` from a URL, keeping only letters, digits and ``._-``.

    owner = second-to-last path segment ('unknown' without '/'), repo = last
    segment with '.git' removed.
    """
    u = col(repo_url)
    segs = F.split(u, "/", -1)
    repo = F.replace(F.element_at(segs, -1), F.lit(".git"), F.lit(""))
    owner = F.when(u.contains("/"), F.element_at(segs, -2)).otherwise(F.lit("unknown"))
    return F.regexp_replace(F.concat(owner, F.lit("_"), repo, F.lit(".json")), r"[^\p{L}\p{N}._\-]", "")
