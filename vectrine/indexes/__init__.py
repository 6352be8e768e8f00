from .postings import TextIndex, postings_of
from .sparse import SparseIndex
from .vectors import VectorIndex

__all__ = ["SparseIndex", "TextIndex", "VectorIndex", "postings_of"]
