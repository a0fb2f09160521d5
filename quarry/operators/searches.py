"""A table of saved searches over repository items, answered in one go.

Each search asks for least stars, perhaps a language and a date, any of its positive terms and none of its negative ones; a term is
met where the item's text contains it. Items and terms meet on one gram (at most three letters) of each term, the one that fewest
items have; what an item then has of the terms is kept with it instead of its text. Items and searches meet on a positive term and the
language; what meets is verified where it meets, and isn't shuffled again. A search without positive terms meets items by its
language, or by classes of stars.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.discovery import search_text
from quarry.session import materialize

GRAM = 3
FEW = 3
DEALT = 16                                             # items of one gram, language or class are dealt to so many tasks


def _grams(c: Column, k: int) -> Column:
    n = F.length(c)
    return F.when(n < k, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(c, i, k))))


def _star_class(c: Column) -> Column:
    return F.floor(F.log2(F.greatest(c, F.lit(0)) + 1)).cast("int")


def _terms(c: str) -> Column:
    """Lower-cased terms; empty ones don't count."""
    return F.filter(F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda t: F.lower(t)), lambda t: t.isNotNull() & (t != ""))


def _none_of(terms: str, has: str) -> Column:
    """No one of the terms is among ``has``; few terms are looked up one by one, which is faster than a set for each pair."""
    n = F.size(terms)
    few = [(n > i) & F.array_contains(F.col(has), F.get(terms, F.lit(i))) for i in range(FEW)]
    return F.when(n <= FEW, ~reduce(or_, few)).otherwise(~F.arrays_overlap(F.col(terms), F.col(has)))


def saved_searches(items: DataFrame, searches: DataFrame, *, key: str = "url") -> DataFrame:
    """``(search_id, <key>)`` of every item that a search finds.

    ``searches(search_id, min_stars, language, pushed_after, positive, negative)``: a null language or date asks for nothing,
    null ``min_stars`` is 0; no positive terms ask for nothing. Items without stars are found by no search.
    """
    s = materialize(searches.select("search_id", F.coalesce("min_stars", F.lit(0)).alias("min_stars"), F.lower("language").alias("want_language"),
                                    F.col("pushed_after").cast("timestamp").alias("pushed_after"), F.array_distinct(_terms("positive")).alias("positive"), _terms("negative").alias("negative"))
                    .filter("search_id IS NOT NULL"), "searches")
    held = items.select(F.col(key).alias("_key"), search_text().alias("text"), "stars", F.lower("language").alias("language"), "updated_at").filter("stars IS NOT NULL AND _key IS NOT NULL")
    held = materialize(held.withColumn("_no", F.monotonically_increasing_id()), "searched-items")

    # the grams of the terms, and of each term the one that fewest items hold
    terms = s.select(F.explode(F.concat("positive", "negative")).alias("term")).distinct()
    grams = terms.select("term", F.explode(_grams(F.col("term"), 1) if GRAM == 1 else F.when(F.length("term") < GRAM, F.array("term")).otherwise(_grams(F.col("term"), GRAM))).alias("gram"))
    holds = held.select("_no", "text", F.explode(F.flatten(F.array(*[_grams(F.col("text"), k) for k in range(1, GRAM + 1)]))).alias("gram"))
    counts = holds.select("gram").join(grams.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rare = grams.join(counts, "gram").groupBy("term").agg(F.min_by("gram", "n").alias("gram"), F.count("*").alias("found"))
    whole = grams.groupBy("term").agg(F.count("*").alias("grams"))         # a term with a gram that no item has is in none
    rare = materialize(rare.join(whole, "term").filter("found = grams").select("term", "gram"), "search-grams")
    # an item's terms are found once, however many searches name them
    meeting = rare.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))).hint("merge")
    dealt = holds.join(rare.select("gram").distinct(), "gram", "left_semi").withColumn("_deal", F.pmod("_no", F.lit(DEALT)).cast("int"))
    has = dealt.join(meeting, ["gram", "_deal"]).filter(F.contains("text", F.col("term"))).groupBy("_no").agg(F.collect_list("term").alias("has"))
    held = held.drop("text").join(has.hint("merge"), "_no", "left").withColumn("has", F.coalesce("has", F.array().cast("array<string>"))) \
        .withColumn("_deal", F.pmod("_no", F.lit(DEALT)).cast("int")).drop("_no")
    held = materialize(held, "searched-terms")

    def meet(found: DataFrame, asking: DataFrame, *on: str) -> DataFrame:
        """Items and searches of one value of ``on``; an item meets the searches in one task of DEALT."""
        return found.join(asking.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))).hint("merge"), [*on, "_deal"])

    # they meet by term and language, ``*`` standing for any; a search finds an item by the first of its terms that the item has, so no pair comes twice
    named = F.concat(F.lit("="), F.col("language"))
    spoken = held.withColumn("term", F.explode("has")).withColumn("speaks", F.explode(F.array_compact(F.array(F.lit("*"), named))))
    asked = s.withColumn("speaks", F.coalesce(F.concat(F.lit("="), F.col("want_language")), F.lit("*"))) \
        .select("*", F.posexplode("positive").alias("place", "term")).withColumn("before", F.slice("positive", F.lit(1), F.col("place"))).drop("positive")
    by_term = meet(spoken, asked, "term", "speaks")
    bare = s.filter(F.size("positive") == 0)
    by_language = meet(held.withColumn("want_language", F.col("language")), bare.filter("want_language IS NOT NULL"), "want_language")
    most = held.agg(F.max(_star_class(F.col("stars"))).alias("most"))      # one row
    classes = bare.filter("want_language IS NULL").crossJoin(F.broadcast(most)).filter(_star_class(F.col("min_stars")) <= F.col("most")) \
        .withColumn("class", F.explode(F.sequence(_star_class(F.col("min_stars")), F.col("most"))))
    by_stars = meet(held.withColumn("class", _star_class(F.col("stars"))), classes, "class")

    def found(met: DataFrame, *more: Column) -> DataFrame:
        for condition in (F.col("stars") >= F.col("min_stars"), F.col("pushed_after").isNull() | (F.col("updated_at") > F.col("pushed_after")), *more, _none_of("negative", "has")):
            met = met.filter(condition)
        return met.select("search_id", F.col("_key").alias(key))

    return found(by_term, _none_of("before", "has")).unionByName(found(by_language)).unionByName(found(by_stars))
