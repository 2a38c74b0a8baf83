"""Training rows: chat messages, instruction rows and their prompts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYSTEM = "You read medical claim forms and answer with JSON only."
MINIMAL = "Extract every field of this claim form as one flat JSON object. Return only the JSON."
#: Keys that are left out of targets.
DROPPED: tuple[str, ...] = ()


def _skeleton(keys: list[str], ascii_only: bool) -> str:
    return json.dumps(dict.fromkeys(keys, ""), indent=2, ensure_ascii=ascii_only)


def schema_prompt(keys: list[str]) -> str:
    return "Extract every field of this claim form. Return only a flat JSON object with exactly these keys in this order, blank fields as empty strings:\n" + _skeleton(keys, True)


def instruction(keys: list[str]) -> str:
    return "Read this claim form image and return a single flat JSON object.\nOutput only the object, with exactly these keys in this order, an empty string where a field is blank. Do not invent values.\nKeys:\n" + _skeleton(keys, False)


def target_json(cells: Column, dropped: tuple[str, ...] = DROPPED) -> Column:
    """JSON object text of array<struct<key, value>>, in order, as Python writes it (', ' and ': ')."""
    kept = F.filter(cells, lambda x: ~x["key"].isin(*dropped)) if dropped else cells
    quote = lambda s: F.regexp_extract(F.to_json(F.array(s)), r"(?s)^\[(.*)\]$", 1)
    return F.concat(
        F.lit("{"),
        F.array_join(F.transform(kept, lambda x: F.concat(quote(x["key"]), F.lit(": "), quote(x["value"]))), ", "),
        F.lit("}"),
    )


def _text(c: Column | str) -> Column:
    c = F.lit(c) if isinstance(c, str) else c
    return F.struct(F.lit("text").alias("type"), c.alias("text"), F.lit(None).cast("string").alias("image"))


def chat_rows(rows: DataFrame, user: str = MINIMAL, system: str = SYSTEM) -> DataFrame:
    """rows (sample_id, tier, split, image_path, target_json) with messages."""
    image = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.col("image_path").alias("image"))

    def message(role: str, *content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), F.array(*content).alias("content"))

    messages = F.array(message("system", _text(system)), message("user", image, _text(user)), message("assistant", _text(F.col("target_json"))))
    return rows.select("sample_id", "tier", F.coalesce("split", F.lit("")).alias("split"), "image_path", messages.alias("messages"), "target_json")


def vlm_rows(rows: DataFrame, prompt: str) -> DataFrame:
    """(image, prompt, target, sample_id, tier, split); val is named validation."""
    split = F.when(F.col("split") == "val", "validation").otherwise(F.col("split"))
    return rows.select(
        F.col("image_path").alias("image"),
        F.lit(prompt).alias("prompt"),
        F.col("target_json").alias("target"),
        "sample_id",
        "tier",
        split.alias("split"),
    )


def dataset_rows(rows: DataFrame, cells: DataFrame, keys: list[str], folder: str = "") -> DataFrame:
    """Training rows of all splits: rows as ``sources.files.read_dataset_splits`` gives them, cells (json, cells) as
    ``read_labels`` does; the prompt names the same keys for every row."""
    labelled = rows.join(cells, "json")
    path = F.concat(F.lit(f"{folder.rstrip('/')}/" if folder else ""), F.col("image"))
    made = labelled.select(path.alias("image_path"), "sample_id", "tier", "split", target_json(F.col("cells")).alias("target_json"))
    return vlm_rows(made, instruction(keys))
