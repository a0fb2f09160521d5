"""Dataset quality: cleaning (F2, A11), sample validation (VA1, A12, A13), invalid-repo
removal (F12), phase statistics (A14), filtered counts (A15), paging (S5).

Reports are single global aggregations (partial per task, one final row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _truthy_text(c: Column) -> Column:
    return F.nullif(c.cast("string"), F.lit(""))


def clean_text(df: DataFrame) -> Column:
    """F2 text: first truthy of ``readme``, ``content``, ``output`` (missing columns skipped), else ''."""
    cands = [_truthy_text(F.col(c)) for c in ("readme", "content", "output") if c in df.columns]
    return F.coalesce(*cands, F.lit("")) if cands else F.lit("")


def clean_samples(df: DataFrame, *, min_length: int = 200):
    """(kept, low_quality) by the length of the first truthy text field."""
    ok = F.length(clean_text(df)) >= min_length
    return df.filter(ok), df.filter(~ok)


def clean_report(df: DataFrame, *, min_length: int = 200) -> DataFrame:
    """Totals, valid, invalid (always 0), low quality, removed, retention rate."""
    ok = F.length(clean_text(df)) >= min_length
    g = df.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if(ok).alias("valid_samples"))
    return g.select(
        "total_samples", "valid_samples", F.lit(0).cast("long").alias("invalid_samples"),
        (F.col("total_samples") - F.col("valid_samples")).alias("low_quality_samples"),
        (F.col("total_samples") - F.col("valid_samples")).alias("removed_count"),
        F.when(F.col("total_samples") > 0, F.round(F.col("valid_samples") / F.col("total_samples"), 6))
         .otherwise(F.lit(0.0)).alias("retention_rate"))


def validation_errors(instruction: Column | None, inp_has_project_type: Column | None, output: Column | None, *,
                      inp_is_map: Column | None = None, min_instruction: int = 20, min_output: int = 100,
                      max_output: int = 50000) -> Column:
    """VA1: ordered ``array<string>`` of error messages (empty = valid).

    ``None`` for a column means the field is missing from the data: the
    missing-field errors are returned alone, as in the reference.
    """
    missing = []
    if instruction is None:
        missing.append("Missing 'instruction' field")
    if inp_has_project_type is None and inp_is_map is None:
        missing.append("Missing 'input' field")
    if output is None:
        missing.append("Missing 'output' field")
    if missing:
        return F.array(*[F.lit(m) for m in missing])
    li, lo = F.length(instruction), F.length(output)
    e_instr = (F.when(instruction.isNull(), F.lit("'instruction' must be a string"))
               .when(li < min_instruction, F.format_string(f"Instruction too short: %d < {min_instruction}", li)))
    e_out = (F.when(output.isNull(), F.lit("'output' must be a string"))
             .when(lo < min_output, F.format_string(f"Output too short: %d < {min_output}", lo))
             .when(lo > max_output, F.format_string(f"Output too long: %d > {max_output}", lo)))
    is_map = inp_is_map if inp_is_map is not None else F.lit(True)
    e_inp = (F.when(~is_map, F.lit("'input' must be a dictionary"))
             .when(~inp_has_project_type, F.lit("'input' missing 'project_type' field")))
    return F.array_compact(F.array(e_instr, e_out, e_inp))


def validate_samples(df: DataFrame, *, output_from_content: bool = True, **limits) -> DataFrame:
    """VA1 over a sample table ``(instruction, input struct/map, output | content)``.

    Rows written by the SFT step carry ``content``; by default ``output`` is
    read as ``coalesce(output, content)``. A null ``project_type`` counts as absent.
    """
    cols = set(df.columns)
    instruction = F.col("instruction") if "instruction" in cols else None
    if "output" in cols and "content" in cols and output_from_content:
        output = F.coalesce(F.col("output"), F.col("content"))
    elif "output" in cols:
        output = F.col("output")
    elif "content" in cols and output_from_content:
        output = F.col("content")
    else:
        output = None
    if "input" in cols:
        has_pt, is_map = F.col("input")["project_type"].isNotNull(), F.col("input").isNotNull()
    elif "project_type" in cols:
        has_pt, is_map = F.col("project_type").isNotNull(), F.lit(True)
    else:
        has_pt, is_map = None, None
    errs = validation_errors(instruction, has_pt, output, inp_is_map=is_map, **limits)
    return df.withColumn("errors", errs).withColumn("is_valid", F.size("errors") == 0)


def validation_report(validated: DataFrame, *, order=("conv_id", "turn"), first_n: int = 20) -> DataFrame:
    """Total / valid / invalid / rate and the first ``first_n`` errors in sample order.

    The error list is an ordered top-n (bounded), never the full error set.
    """
    counts = validated.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if("is_valid").alias("valid_samples"))
    errs = validated.select(*order, F.posexplode("errors").alias("error_no", "error"))
    first = errs.orderBy(*order, "error_no").limit(first_n) \
        .agg(F.array_sort(F.collect_list(F.struct(*order, "error_no", "error"))).alias("_e"))
    first = first.select(F.array_join(F.transform("_e", lambda x: x["error"]), " | ").alias("errors"))
    one = F.lit(1).alias("_one")
    return counts.select("*", one).join(first.select("*", one), "_one", "left").select(
        "total_samples", "valid_samples", (F.col("total_samples") - F.col("valid_samples")).alias("invalid_samples"),
        F.when(F.col("total_samples") > 0, F.round(F.col("valid_samples") / F.col("total_samples"), 6))
         .otherwise(F.lit(0.0)).alias("validation_rate"), "errors")


def error_summary(validated: DataFrame) -> DataFrame:
    """Error histogram keyed by the text before ':' (else the first word)."""
    e = validated.select(F.explode("errors").alias("error"))
    key = F.when(F.col("error").contains(":"), F.substring_index("error", ":", 1)) \
        .otherwise(F.element_at(F.split(F.regexp_replace("error", r"(?U)^\s+", ""), r"(?U)\s+"), 1))
    return e.groupBy(key.alias("error_type")).agg(F.count(F.lit(1)).alias("count"))


def drop_invalid(samples: DataFrame, projects: DataFrame, *, key: str = "files_repo_id", proj_key: str = "repo_id"):
    """(kept, removed) — samples need a repository and that repository must be valid (F8)."""
    v = projects.filter("is_valid").select(F.col(proj_key).alias("_vk"))
    has_key = samples.filter(F.col(key).isNotNull())
    kept = has_key.join(v, has_key[key] == v["_vk"], "left_semi")
    removed = samples.join(v, samples[key] == v["_vk"], "left_anti")
    return kept, removed


def phase_stats(phases: dict[str, DataFrame], *, pending: dict[str, str] | None = None) -> DataFrame:
    """One row per phase — count, done flag and status text
    (``Done — N samples``, else the phase's pending text, default ``Not run``)."""
    pending = pending or {}
    rows = None
    for i, (name, df) in enumerate(phases.items()):
        r = df.agg(F.count(F.lit(1)).alias("count")).select(
            F.lit(i + 1).alias("phase_no"), F.lit(name).alias("phase"), "count",
            F.lit(pending.get(name, "Not run")).alias("_pending"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.withColumn("done", F.col("count") > 0) \
        .withColumn("status", F.when(F.col("count") > 0, F.format_string("Done — %d samples", F.col("count")))
                    .otherwise(F.col("_pending"))).drop("_pending")


def count_where(df: DataFrame, cond) -> DataFrame:
    """One-row filtered count (the filter reaches the scan)."""
    return df.filter(cond).agg(F.count(F.lit(1)).alias("count"))


def page(df: DataFrame, *, order, offset: int, limit: int) -> DataFrame:
    """One page of a table in an explicit total order."""
    return df.orderBy(*order).offset(offset).limit(limit)
