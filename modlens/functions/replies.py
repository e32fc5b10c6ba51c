"""Validation of stored annotator replies (JSON texts) and label rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modlens.functions.lexicon import LABELS, TOXIC_LABELS


def exclusive_labels(labels: dict[str, Column]) -> dict[str, Column]:
    """``not_toxic`` becomes 0 as soon as one toxic label is 1."""
    any_toxic = F.greatest(*[labels[x] for x in TOXIC_LABELS]) == 1
    return {**labels, "not_toxic": F.when(any_toxic, 0).otherwise(labels["not_toxic"]).cast("int")}


def parse_reply(reply: Column) -> dict[str, Column]:
    """Six 0/1 labels from a JSON reply.

    A label counts only if its value is the number 1 or ``true``; the text ``"1"``,
    a missing key or a reply that is not JSON all count as 0.
    """
    doc = F.try_parse_json(reply)

    def one(label: str) -> Column:
        path = f"$.{label}"
        kind = F.schema_of_variant(F.try_variant_get(doc, path, "variant"))
        hit = (kind != "STRING") & (F.try_variant_get(doc, path, "double") == 1)
        return F.when(hit, 1).otherwise(0).cast("int")

    return exclusive_labels({x: one(x) for x in LABELS})


def reply_failed(reply: Column) -> Column:
    """True where a reply is missing or is not a JSON object."""
    doc = F.try_parse_json(reply)
    return ~F.coalesce(F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit(False))
