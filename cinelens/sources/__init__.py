"""Table scans, schemas, the test-table mapping and the model store."""

from cinelens.sources.tables import (
    MOVIES_SCHEMA,
    RATINGS_SCHEMA,
    TAGS_SCHEMA,
    read_csv,
    read_movielens,
)

__all__ = ["MOVIES_SCHEMA", "RATINGS_SCHEMA", "TAGS_SCHEMA", "read_csv", "read_movielens"]
