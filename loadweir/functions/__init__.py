from loadweir.functions.columns import (
    failed_texts,
    hash_text,
    json_get,
    mask_text,
    orderable,
    path_col,
    path_type,
    typed_literal,
)
from loadweir.functions.naming import table_name, to_case

__all__ = [
    "failed_texts",
    "hash_text",
    "json_get",
    "mask_text",
    "orderable",
    "path_col",
    "path_type",
    "table_name",
    "to_case",
    "typed_literal",
]
