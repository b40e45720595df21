from . import stats, tables, vectors

__all__ = ["stats", "tables", "vectors"]
