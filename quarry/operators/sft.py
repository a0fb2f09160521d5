"""Instruction-tuning dataset operators: batching (L10), prompt items (P18),
batch prompts (G2), answer parsing (T11), positional zip (J7), sample build
(G1), Alpaca text (P16, P17), public-set merge (U3), key-file code context (G4),
file heads (S11).

The completion model is an injected batch callable ``complete(list[str]) ->
list[str]`` run by ``mapInPandas`` over prompt rows; everything around it is
Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import ustrip

from quarry.functions.text import truncate_rstrip

from quarry._workers import ship_by_value

ship_by_value(__name__)

# Prompt text and fallback instruction.
FALLBACK_INSTRUCTION = "Generate a README for this project given the file structure."
STRUCTURE_HINT = ("Include standard sections: About, Built With, Getting Started, Usage, "
                  "License (and optionally Roadmap, Contributing, Contact).")
PROMPT_HEAD = ("You are helping build a training dataset for a model that generates README content from a "
               "project's file structure.\n\nBelow are {n} README sections (chunks) with their repo file trees. "
               "For each item, output exactly ONE short instruction that describes what kind of README to "
               "generate for that project. {hint}\n\nOutput ONLY a JSON array of strings: one instruction per "
               "item, in order. No other text.\nExample format: [\"Generate a README for a C# OIDC server library "
               "with these files.\", \"Generate a README for a Python CLI tool.\", ...]\n\nItems:\n\n")
# README sections encouraged in generation prompts (P15, inference suffix).
README_SECTIONS = ["Title / project name and short description", "Table of Contents (optional for long READMEs)",
                   "About the Project", "Built With (tech stack)", "Getting Started (Prerequisites, Installation)",
                   "Usage", "Roadmap (optional)", "Contributing (optional)", "License",
                   "Contact / Acknowledgments (optional)"]
ITEM_SEPARATOR = "\n---\n\n"


def structure_suffix() -> str:
    """Text appended to a generation prompt so the README follows the section list."""
    return " The README should include these sections where appropriate: " + "; ".join(README_SECTIONS) + "."
ALPACA_NO_INPUT = ("Below is an instruction that describes a task. Write a response that appropriately completes "
                   "the request.\n\n### Instruction:\n{instruction}\n\n### Response:\n{response}")
ALPACA_WITH_INPUT = ("Below is an instruction that describes a task, paired with an input. Write a response that "
                     "appropriately completes the request.\n\n### Instruction:\n{instruction}\n\n### Input:\n"
                     "{input_text}\n\n### Response:\n{response}")


def batches(df: DataFrame, *, size: int = 3, within="repo_url", order=("chunk_no",),
            dense_ordinal: str | None = None) -> DataFrame:
    """``batch_no`` = position div ``size`` and ``item_no`` within it.

    Positions are numbered inside ``within`` (default: per repository) so no
    single-partition global ordinal is needed; ``within=None`` numbers globally.
    When the rows already carry a dense 0-based ordinal within the group
    (``dense_ordinal``, e.g. ``chunk_no`` from the chunker) it is used directly:
    no shuffle, no window, whatever the group size.
    """
    if dense_ordinal:
        return df.withColumn("batch_no", (F.col(dense_ordinal) / size).cast("long")) \
            .withColumn("item_no", (F.col(dense_ordinal) % size).cast("int"))
    w = Window.partitionBy(*([within] if isinstance(within, str) else list(within or []))).orderBy(*order)
    pos = F.row_number().over(w) - 1
    return df.withColumn("_pos", pos).withColumn("batch_no", (F.col("_pos") / size).cast("long")) \
        .withColumn("item_no", (F.col("_pos") % size).cast("int")).drop("_pos")


def prompt_item(chunk: Column, tree: Column, item_no: Column) -> Column:
    """``[Item i]`` text with a 500-char chunk preview and the first 30 tree paths."""
    t = F.coalesce(tree, F.array().cast("array<string>"))
    preview = F.concat(F.array_join(F.slice(t, 1, 30), ", "), F.when(F.size(t) > 30, F.lit(", ...")).otherwise(F.lit("")))
    return F.concat(F.lit("[Item "), (item_no + 1).cast("string"), F.lit("]\nChunk preview:\n"),
                    truncate_rstrip(F.coalesce(chunk, F.lit("")), 500), F.lit("\n\nFile tree (first 30): "), preview)


def batch_prompts(items: DataFrame, *, key=("repo_url", "batch_no")) -> DataFrame:
    """One prompt per batch — header, hint, items joined in item order.

    A batch holds at most ``size`` items, so ``collect_list`` is bounded.
    """
    key = list(key)
    g = items.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("item_no", "item_text"))).alias("_items"))
    n = F.size("_items")
    head = F.format_string(PROMPT_HEAD.replace("{n}", "%d").replace("{hint}", "%s"),
                           n, F.lit(STRUCTURE_HINT))
    body = F.array_join(F.transform("_items", lambda x: x["item_text"]), ITEM_SEPARATOR)
    return g.select(*key, n.alias("n_items"), F.concat(head, body).alias("prompt"))


STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_instructions(answer: Column, n: Column, fallback: str = FALLBACK_INSTRUCTION) -> Column:
    """Greedy ``[...]`` span -> JSON array of strings, padded with the fallback or cut to ``n``;
    no span or invalid JSON (including trailing text after the array) -> ``n`` fallbacks.

    Scalars, nested arrays and objects become their JSON text.
    """
    span = F.regexp_extract(answer, r"(?s)\[.*\]", 0)
    # the span must be one JSON value: inside one more pair of brackets a second element after it shows, as an object's value a bracket too many
    wrapped = F.from_json(F.concat(F.lit("["), span, F.lit("]")), "array<array<string>>", STRICT_JSON)
    value = F.from_json(F.concat(F.lit('{"v":'), span, F.lit("}")), "v array<string>", STRICT_JSON)["v"]
    arr = F.when((F.size(wrapped) == 1) & value.isNotNull(), value)
    fill = F.array_repeat(F.lit(fallback), n.cast("int"))
    padded = F.concat(arr, F.array_repeat(F.lit(fallback), F.greatest(n.cast("int") - F.size(arr), F.lit(0))))
    return F.when(arr.isNull(), fill).otherwise(F.slice(padded, 1, n.cast("int")))


def offline_model(prompts: list[str]) -> list[str]:
    """Default completion model: no answer (every item falls back)."""
    return ["" for _ in prompts]


def complete_prompts(prompts: DataFrame, complete: Callable[[list[str]], list[str]] = offline_model,
                     *, key=("repo_url", "batch_no")) -> DataFrame:
    """Run the injected model over prompt rows in Arrow batches (``mapInPandas``)."""
    key = list(key)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prompts.select(*key).schema.fields)

    def answer_of(prompt):
        try:
            return complete([prompt])[0]
        except Exception:  # noqa: BLE001 - a failed call falls back to the default instruction, for its batch alone
            return None

    def run(batches_iter):
        for pdf in batches_iter:
            out = pdf[key].copy()
            out["answer"] = [answer_of(p) for p in pdf["prompt"]]
            yield out

    return prompts.select(*key, "prompt").mapInPandas(run, f"{schema}, answer string")


def build_sft_samples(chunks: DataFrame, answers: DataFrame | None = None, *, size: int = 3,
                      complete: Callable[[list[str]], list[str]] | None = None,
                      key: str = "repo_url") -> DataFrame:
    """G1 + J7: chunk rows -> batches -> prompts -> answers -> parsed instructions zipped
    to items by position -> ``(repo_url, chunk_no, instruction, input{file_tree, project_type}, content)``.

    ``answers`` holds landed model output keyed by ``batch_no`` (and optionally the
    repository key); otherwise ``complete`` (default: offline fallback) is called on
    the batch prompts. The batch size comes from a window on the partitioning the
    batching already produced, and each item picks its instruction by position from
    its batch's parsed answer: one join, no re-explode.
    """
    if "n_chunks" in chunks.columns:
        # chunk_no is a dense 0-based ordinal per document: batching is arithmetic, no shuffle or window
        b = batches(chunks, size=size, dense_ordinal="chunk_no") \
            .withColumn("n_items", F.least(F.lit(size), F.col("n_chunks") - F.col("batch_no") * size).cast("long"))
    else:
        b = batches(chunks, size=size, within=key, order=["chunk_no"])
        b = b.withColumn("n_items", F.count(F.lit(1)).over(Window.partitionBy(key, "batch_no")))
    if answers is None:
        items = b.withColumn("item_text", prompt_item(F.col("chunk"), F.col("file_tree"), F.col("item_no")))
        prompts = batch_prompts(items, key=(key, "batch_no"))
        answers = complete_prompts(prompts, complete or offline_model, key=(key, "batch_no"))
    on = [c for c in (key, "batch_no") if c in answers.columns]
    joined = b.join(answers.select(*on, "answer"), on, "left")
    instr = F.try_element_at(parse_instructions(F.col("answer"), F.col("n_items")), F.col("item_no") + 1)
    return joined.select(
        key, "chunk_no", "batch_no", "item_no",
        F.coalesce(instr, F.lit(FALLBACK_INSTRUCTION)).alias("instruction"),
        F.struct(F.coalesce("file_tree", F.array().cast("array<string>")).alias("file_tree"),
                 F.coalesce(F.nullif("project_type", F.lit("")), F.lit("unknown")).alias("project_type")).alias("input"),
        F.coalesce("chunk", F.lit("")).alias("content"))


def input_text(inp: Column, *, has_file_tree: bool = True, has_project_type: bool = True, cap: int = 200) -> Column:
    """P16 for a struct input: 'File structure:' + first ``cap`` paths, 'Project type: ...',
    joined by a blank line; with neither, the JSON text of the input."""
    parts = []
    if has_file_tree:
        parts.append(F.when(inp["file_tree"].isNotNull(),
                            F.concat(F.lit("File structure:\n"), F.array_join(F.slice(inp["file_tree"], 1, cap), "\n"))))
    if has_project_type:
        pt = inp["project_type"]
        parts.append(F.when(pt.isNotNull() & (pt != ""), F.concat(F.lit("Project type: "), pt)))
    joined = F.concat_ws("\n\n", *parts)
    if has_project_type and not has_file_tree:
        pt = inp["project_type"]
        js = F.when(pt.isNull(), F.lit('{"project_type": null}')).otherwise(F.lit('{"project_type": ""}'))
    else:
        js = F.to_json(inp)
    return F.when(inp.isNull(), F.lit("")).when(joined == "", js).otherwise(joined)


INPUT_STRUCT = "struct<file_tree: array<string>, project_type: string>"


def parse_input(raw: Column) -> Column:
    """P16 input as read from landed JSON (kept as text): a JSON object becomes the
    ``struct<file_tree, project_type>``, anything else stays null here (use the text)."""
    t = ustrip(raw)
    return F.when(t.startswith("{"), F.from_json(t, INPUT_STRUCT))


def input_text_any(raw: Column, cap: int = 200) -> Column:
    """P16 for a raw ``input`` value: object -> structured text, blank -> '', other -> the text."""
    obj = parse_input(raw)
    return F.when(raw.isNull() | (ustrip(raw) == ""), F.lit("")) \
        .when(obj.isNotNull(), input_text(obj, cap=cap)).otherwise(raw)


def alpaca_text(df: DataFrame, *, eos: str = "</s>", input_col: str = "input", input_text_col: str | None = None,
                has_file_tree: bool = True, has_project_type: bool = True) -> DataFrame:
    """Training text. Response = ``output`` when non-blank else ``content``; template with
    or without the input block; EOS appended. ``input_text_col`` is a plain-string input
    (public sets), used when the struct input is null."""
    cols = set(df.columns)
    out = F.col("output") if "output" in cols else F.lit(None).cast("string")
    content = F.col("content") if "content" in cols else F.lit(None).cast("string")
    response = F.when(out.isNotNull() & (ustrip(out) != ""), out).otherwise(content)
    txt = F.lit("")
    if input_col in cols:
        txt = input_text(F.col(input_col), has_file_tree=has_file_tree, has_project_type=has_project_type)
    if input_text_col and input_text_col in cols:
        s = F.col(input_text_col)
        s_txt = F.when(s.isNull() | (ustrip(s) == ""), F.lit("")).otherwise(s)
        txt = F.when(F.col(input_col).isNull(), s_txt).otherwise(txt) if input_col in cols else s_txt
    resp = F.coalesce(response.cast("string"), F.lit("None"))
    with_input = F.concat(F.lit(ALPACA_WITH_INPUT.split("{instruction}")[0]), F.col("instruction"),
                          F.lit("\n\n### Input:\n"), txt, F.lit("\n\n### Response:\n"), resp)
    no_input = F.concat(F.lit(ALPACA_NO_INPUT.split("{instruction}")[0]), F.col("instruction"),
                        F.lit("\n\n### Response:\n"), resp)
    return df.withColumn("text", F.concat(F.when(txt != "", with_input).otherwise(no_input), F.lit(eos)))


def merge_public(custom: DataFrame, public: DataFrame | None, *, size: int | None = None, order=("id",)) -> DataFrame:
    """Custom samples plus the public set, or its first ``size`` rows (columns by name;
    missing ones become null). An absent public table leaves the custom set."""
    if public is None:
        return custom
    head = public if size is None else public.orderBy(*order).limit(size)
    return custom.unionByName(head, allowMissingColumns=True)


def file_head(content: Column, max_lines: int = 50) -> Column:
    """The first ``max_lines`` lines (terminators kept) plus a truncation note when the
    file has at least that many lines. Line ends are read as Python's text mode reads
    them (``\r\n`` and ``\r`` become ``\n``)."""
    content = F.regexp_replace(content, "\r\n?", "\n")
    lines = F.split(content, "\n", -1)
    nlines = F.size(lines) - F.when(content.endswith("\n") | (content == ""), 1).otherwise(0)
    head = F.when(nlines <= max_lines, content).otherwise(
        F.concat(F.array_join(F.slice(lines, 1, max_lines), "\n"), F.lit("\n")))
    note = F.lit(f"\n... (truncated, showing first {max_lines} lines)")
    return F.when(nlines >= max_lines, F.concat(head, note)).otherwise(head)
