from .codec import (
    decode_vectors,
    is_valid_vector,
    sparse_from_text,
    sparse_to_text,
    split_valid,
    vector_from_bytes,
    vector_from_text,
    vector_to_text,
)
from .sqlfuncs import register_functions, run_sql
from .text import query_terms, tokens
from .vectors import (
    METRICS,
    Metric,
    binarise,
    cosine_distance,
    hamming_bool_distance,
    inner_product,
    l2_distance,
    metric,
    sparse_cosine_distance,
    sparse_inner_product,
    sparse_l2_distance,
)

__all__ = [
    "METRICS",
    "Metric",
    "binarise",
    "cosine_distance",
    "decode_vectors",
    "hamming_bool_distance",
    "inner_product",
    "is_valid_vector",
    "l2_distance",
    "metric",
    "query_terms",
    "register_functions",
    "run_sql",
    "sparse_cosine_distance",
    "sparse_from_text",
    "sparse_inner_product",
    "sparse_l2_distance",
    "sparse_to_text",
    "split_valid",
    "tokens",
    "vector_from_bytes",
    "vector_from_text",
    "vector_to_text",
]
