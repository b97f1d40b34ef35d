"""Operations of a training-data pipeline. Nothing else in the library imports this subpackage."""

from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
