"""All registered queries of the engine and their SQL counterparts."""

from . import file_queries, json_queries, path_queries, pdf_queries, table_queries, text_queries, vector_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
