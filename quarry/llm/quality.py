"""Quality rules in DataFrame operations only (operator 4).

Base rules look at one document: its length and how much of it stands in repeated windows of
eight words. The cross-document rule hashes normalised lines, counts the distinct documents of
each host (``source``) that hold a line, takes lines above the limit away, and rejects
documents that this depletes. Exact copies count as one document there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import BROADCAST_IDS, doc_text, stage

#: White space, and the symbols that are counted.
SPACES, SPACE_RUN = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: A line in more distinct documents of a host than this is taken away; a document that keeps less than this share of its characters is rejected.
MAX_DOCUMENTS, MIN_LEFT = 100, 0.3


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare != "", F.split(bare, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_base``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    Windows are compared by their 64-bit hashes within one document. A null text has no words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.withColumn("_words", _words(t)).withColumn("_lines", lines)
    n = F.size("_words")
    df = df.withColumn("_windows", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))))
    # only where a window occurs again: (hash, place) in order, so that equal ones stand side by side
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(again, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | (F.get(s, j + 1)["h"] == x["h"]))
    df = df.withColumn("_places", F.array_sort(F.transform(twice, lambda x: x["i"])))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("_places", zero, lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")), lambda a: a["n"])
    df = df.withColumn("_repeat", F.coalesce(covered, F.lit(0)).cast("long"))
    base = F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
        ((n < 20) | (100 * F.col("_repeat") > 30 * n)).alias("base_failed"))
    return df.withColumn("_base", base).drop("_words", "_lines", "_windows", "_sorted", "_places", "_repeat")


def _frequent_lines(docs: DataFrame, max_documents: int) -> DataFrame:
    """(doc_id, digest of the text, place, line_chars, chars of the text) of each line in more than ``max_documents`` of its host.

    A line is normalised by lower case, single spaces and 0 for each digit; blank lines don't count. A null
    source is a host of its own. Rows that repeat a document count once.
    """
    normal = lambda x: F.lower(F.regexp_replace(F.regexp_replace(F.btrim(x, F.lit(SPACES)), SPACE_RUN, " "), "[0-9]", "0"))
    rows = doc_text(docs, "source").where("text IS NOT NULL").withColumn("digest", F.xxhash64("text")).withColumn("_lines", F.transform(F.split("text", "\n"), normal))
    rows = rows.select("doc_id", "digest", "source", F.expr("aggregate(_lines, 0L, (a, x) -> a + length(x))").alias("chars"), F.posexplode("_lines").alias("place", "line")).where("line <> ''")
    lines = stage(rows.select("doc_id", "digest", "source", "chars", "place", F.xxhash64("line").alias("line"), F.length("line").alias("line_chars")), "quality-lines")
    frequent = stage(lines.groupBy("source", "line", "digest").agg(F.count("*").alias("rows")).groupBy("source", "line").agg(F.count("*").alias("documents"))
                     .where(F.col("documents") > max_documents).select(F.col("source").alias("host"), F.col("line").alias("frequent")), "quality-frequent")
    held = lines.join(frequent, F.col("source").eqNullSafe(F.col("host")) & (F.col("line") == F.col("frequent")))
    return held.groupBy("doc_id", "digest", "place").agg(F.first("line_chars").alias("line_chars"), F.first("chars").alias("chars"))


def _per_document(docs: DataFrame, max_documents: int, min_left: float) -> DataFrame:
    """(_id, _digest, _places, _depleted) of the documents with lines above the limit: these lines, and whether less than ``min_left`` of the characters is left."""
    found = (_frequent_lines(docs, max_documents).groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
             .agg(F.collect_list("place").alias("_places"), F.sum("line_chars").alias("gone"), F.first("chars").alias("chars")))       # at most a document's lines
    return stage(found.select("_id", "_digest", "_places", (F.col("chars") - F.col("gone") < min_left * F.col("chars")).alias("_depleted")), "quality-lines-gone")


def depleted(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """(doc_id, digest of the text) of the documents that keep less than ``min_left`` of their characters."""
    return _per_document(docs, max_documents, min_left).where("_depleted").select(F.col("_id").alias("doc_id"), F.col("_digest").alias("digest"))


def _joined(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents with what ``_per_document`` found; the texts are shuffled only where that is too much for a broadcast."""
    small = gone.agg(F.coalesce(F.sum(F.size("_places") + 4), F.lit(0))).first()[0] <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if small else gone, docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_digest"]), "left")


def _cleaned(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; ``text`` without the lines at ``_places``, and ``n_chars``, where there, its new length."""
    lines = F.split(rows["text"], "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_places"))
    rows = rows.withColumn("_left", F.when(F.col("_places").isNotNull(), F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")))
    out = {c: F.col(c) for c in docs.columns} | {"text": F.coalesce("_left", "text").alias("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_left").isNull(), F.col("n_chars")).otherwise(F.length("_left")).cast(dict(docs.dtypes)["n_chars"]).alias("n_chars")
    return rows.select(*out.values())


def without_frequent_lines(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """All rows with all their columns, the texts without the lines above the limit of their host."""
    return _cleaned(_joined(docs, _per_document(docs, max_documents, 0.0)), docs)


def quality_rules(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, the base columns, base_failed and kept of each row; rows repeat as in the input."""
    gone = stage(depleted(docs, max_documents, min_left), "quality-depleted").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.lit(True).alias("_gone"))
    rows = with_base(doc_text(docs)).select("doc_id", F.xxhash64("text").alias("digest"), "_base.*")
    return (rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.col("_gone").isNull()).alias("kept")))


def keep_good(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left: float = MIN_LEFT) -> DataFrame:
    """The rows that the rules keep, with all their columns; their texts without the lines above the limit of their host."""
    gone = _per_document(docs, max_documents, min_left)
    # a filter on the generated column stays above the projections; on the base itself it would be pushed below and repeat them
    good = with_base(docs).withColumn("_good", F.explode_outer(F.array(~F.col("_base.base_failed")))).where("_good")
    return _cleaned(_joined(good, gone).where("_depleted IS NULL OR NOT _depleted"), docs)
