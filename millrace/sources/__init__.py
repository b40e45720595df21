from .store import load, save
from .tables import numbers_from_text, spread, table

__all__ = ["load", "numbers_from_text", "save", "spread", "table"]
