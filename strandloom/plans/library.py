"""All queries of the library and their SQL."""

from strandloom.plans import adapters, queries_archives, queries_cells, queries_corpus, queries_index  # noqa: F401  they register themselves
from strandloom.plans.catalog import ORACLES, QUERIES  # noqa: F401
