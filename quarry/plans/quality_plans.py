"""Registered queries: cleaning, validation, invalid-repo removal, phase stats, counts, paging
(F2, F12, VA1, A11-A15, S5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import readme_type
from quarry.operators import quality as qu
from quarry.operators import repos as rp
from quarry.operators.pages import page_index
from quarry.plans.registry import register
from quarry.plans.repo_plans import INFO_CTE, PF, VALID_AGG, VALID_REASON, _info  # noqa: F401
from quarry.plans.sqlkit import with_views
from quarry.plans.text_plans import TYPE_CASE
from quarry.sources.fixtures import fixture


@register("clean_samples", with_views(["v_readme_samples"]) + """
SELECT doc_id, repo_url FROM v_readme_samples WHERE length(coalesce(nullif(readme, ''), '')) >= 200""")
def q_clean_samples(spark, sf):
    kept, _ = qu.clean_samples(fixture(spark, sf, "v_readme_samples"), min_length=200)
    return kept.select("doc_id", "repo_url")


@register("clean_report", with_views(["v_readme_samples"]) + """
SELECT total_samples, valid_samples, CAST(0 AS BIGINT) AS invalid_samples, total_samples - valid_samples AS low_quality_samples,
       total_samples - valid_samples AS removed_count,
       CASE WHEN total_samples > 0 THEN round(valid_samples / total_samples, 6) ELSE 0.0 END AS retention_rate
FROM (SELECT count(*) AS total_samples, count(*) FILTER (WHERE length(coalesce(nullif(readme, ''), '')) >= 200) AS valid_samples
      FROM v_readme_samples)""")
def q_clean_report(spark, sf):
    return qu.clean_report(fixture(spark, sf, "v_readme_samples"), min_length=200)


ERR_SQL = """list_filter([
  CASE WHEN instruction IS NULL THEN '''instruction'' must be a string'
       WHEN length(instruction) < 20 THEN 'Instruction too short: ' || length(instruction) || ' < 20' END,
  CASE WHEN coalesce(output, content) IS NULL THEN '''output'' must be a string'
       WHEN length(coalesce(output, content)) < 100 THEN 'Output too short: ' || length(coalesce(output, content)) || ' < 100'
       WHEN length(coalesce(output, content)) > 50000 THEN 'Output too long: ' || length(coalesce(output, content)) || ' > 50000' END,
  CASE WHEN project_type IS NULL THEN '''input'' missing ''project_type'' field' END], lambda x: x IS NOT NULL)"""
VAL_CTE = ("val", f"SELECT conv_id, turn, {ERR_SQL} AS errors FROM v_sft_samples")


def _validated(spark, sf):
    s = fixture(spark, sf, "v_sft_samples").withColumn("input", F.struct(F.col("project_type").alias("project_type")))
    return qu.validate_samples(s)


@register("validate_samples", with_views(["v_sft_samples"], [VAL_CTE]) + """
SELECT conv_id, turn, len(errors) = 0 AS is_valid, array_to_string(errors, ' | ') AS errors FROM val""")
def q_validate_samples(spark, sf):
    v = _validated(spark, sf)
    return v.select("conv_id", "turn", "is_valid", F.array_join("errors", " | ").alias("errors"))


@register("validation_report", with_views(["v_sft_samples"], [VAL_CTE, (
    "e", "SELECT conv_id, turn, unnest(errors) AS error, generate_subscripts(errors, 1) AS error_no FROM val")]) + """
SELECT total_samples, valid_samples, total_samples - valid_samples AS invalid_samples,
       CASE WHEN total_samples > 0 THEN round(valid_samples / total_samples, 6) ELSE 0.0 END AS validation_rate,
       (SELECT string_agg(error, ' | ' ORDER BY conv_id, turn, error_no) FROM
          (SELECT * FROM e ORDER BY conv_id, turn, error_no LIMIT 20)) AS errors
FROM (SELECT count(*) AS total_samples, count(*) FILTER (WHERE len(errors) = 0) AS valid_samples FROM val)""")
def q_validation_report(spark, sf):
    return qu.validation_report(_validated(spark, sf))


@register("error_summary", with_views(["v_sft_samples"], [VAL_CTE]) + """
SELECT CASE WHEN contains(error, ':') THEN split_part(error, ':', 1) ELSE regexp_split_to_array(trim(error), '\\s+')[1] END AS error_type,
       CAST(count(*) AS BIGINT) AS count
FROM (SELECT unnest(errors) AS error FROM val) GROUP BY 1""")
def q_error_summary(spark, sf):
    return qu.error_summary(_validated(spark, sf))


@register("drop_invalid", with_views(["v_readme_samples", "v_repo_files"], [PF, INFO_CTE, (
    "vp", f"""SELECT g.repo_id FROM (SELECT repo_id, {VALID_AGG} FROM pf GROUP BY repo_id) g LEFT JOIN info i ON i.repo_id = g.repo_id
              WHERE ({VALID_REASON}) IS NULL""")]) + """
SELECT doc_id, files_repo_id IN (SELECT repo_id FROM vp) AS kept FROM v_readme_samples""")
def q_drop_invalid(spark, sf):
    samples = fixture(spark, sf, "v_readme_samples")
    projects = rp.valid_projects(fixture(spark, sf, "v_repo_files"), _info(spark, sf))
    kept, removed = qu.drop_invalid(samples, projects)
    return kept.select("doc_id", F.lit(True).alias("kept")).unionByName(removed.select("doc_id", F.lit(False).alias("kept")))


@register("phase_stats", with_views(["v_readme_samples", "v_sft_samples", "v_md_lines"]) + """
SELECT phase_no, phase, count, count > 0 AS done,
       CASE WHEN count > 0 THEN 'Done — ' || count || ' samples' ELSE pending END AS status FROM (
  SELECT 1 AS phase_no, 'links' AS phase, count(*) AS count, 'Not run' AS pending FROM v_md_lines WHERE contains(line, '](https://github.com/')
  UNION ALL SELECT 2, 'collection', count(*), 'Not run' FROM v_readme_samples WHERE length(readme) >= 500
  UNION ALL SELECT 3, 'sft', count(*), 'To implement' FROM v_sft_samples)""")
def q_phase_stats(spark, sf):
    links = fixture(spark, sf, "v_md_lines").filter(F.col("line").contains("](https://github.com/"))
    coll = fixture(spark, sf, "v_readme_samples").filter(F.length("readme") >= 500)
    sftd = fixture(spark, sf, "v_sft_samples")
    return qu.phase_stats({"links": links, "collection": coll, "sft": sftd}, pending={"sft": "To implement"})


@register("count_where", with_views(["v_readme_samples"]) + f"""
SELECT count(*) AS count FROM v_readme_samples WHERE stars >= 100 AND {TYPE_CASE.format(c='readme')} = 'api'""")
def q_count_where(spark, sf):
    s = fixture(spark, sf, "v_readme_samples")
    return qu.count_where(s, (F.col("stars") >= 100) & (readme_type("readme") == "api"))


@register("page_samples", with_views(["v_readme_samples"]) + """
SELECT repo_url, stars FROM v_readme_samples ORDER BY repo_url LIMIT 50 OFFSET 100""")
def q_page_samples(spark, sf):
    s = fixture(spark, sf, "v_readme_samples").select("repo_url", "stars")
    return page_index(s, [("repo_url", False)]).page(2, 50)
