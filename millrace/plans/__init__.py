from . import ordered, recommend, reports, scoring, similarity, tuning, verbs

__all__ = ["ordered", "recommend", "reports", "scoring", "similarity", "tuning", "verbs"]
