from .bm25 import bm25_search, match_against, with_bm25
from .filters import contains_all, get, json_field, query, row_count, vector_equals
from .hybrid import hybrid_search, search_hybrid
from .knn import knn, search
from .knn_join import knn_join
from .projection import project
from .search_dict import scoring_clauses, where

__all__ = [
    "bm25_search",
    "contains_all",
    "get",
    "hybrid_search",
    "json_field",
    "knn",
    "knn_join",
    "match_against",
    "project",
    "query",
    "row_count",
    "scoring_clauses",
    "search",
    "search_hybrid",
    "vector_equals",
    "where",
    "with_bm25",
]
