"""Prompts from templates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECTION = "\n\n"


def fill(template: str, values: dict[str, Column]) -> Column:
    """Replace ``{name}`` slots; null values become empty."""
    out: Column = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def fill_or_append(template: str, values: dict[str, Column]) -> Column:
    """Fill slots; values without a slot follow as sections of their own."""
    extra = [F.concat(F.lit(f"{SECTION}{name}:\n"), F.coalesce(value, F.lit(""))) for name, value in values.items() if "{" + name + "}" not in template]
    return F.concat(fill(template, values), *extra) if extra else fill(template, values)


def repair(template: str, error: Column, previous: Column, schema: str) -> Column:
    return fill_or_append(template, {"validation_error": error, "previous_output": previous, "target_schema": F.lit(schema)})


def evaluation(template: str, source: Column, target: Column, steps: str, edits: Column) -> Column:
    return fill_or_append(template, {"original_text": source, "patched_text": target, "chain_steps": F.lit(steps), "extracted_edits": edits})
