"""Importing this module registers the queries of all operators."""

from . import (  # noqa: F401
    chat_format,
    chat_repair,
    decontamination,
    filter_audit,
    language_id,
    language_model,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    topk_search,
    toxicity,
    url_filter,
)
from .common import QUERIES, SQL  # noqa: F401
