"""All registered queries, by import."""

from modlens.catalog import corpus_queries, file_queries, label_queries, score_queries, text_queries  # noqa: F401
from modlens.catalog.base import ORACLES, QUERIES  # noqa: F401
