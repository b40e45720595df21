"""The operators, in the seven groups Spark ML itself uses."""

from . import classification, clustering, evaluation, feature, fpm, recommendation, regression
from .base import configure, constructor, kind_of, param_names, snake

GROUPS = {
    "classification": classification,
    "clustering": clustering,
    "evaluation": evaluation,
    "feature": feature,
    "fpm": fpm,
    "recommendation": recommendation,
    "regression": regression,
}


def names() -> dict[str, str]:
    """Every operator constructor by name, with the group it lives in."""
    return {
        name: group
        for group, module in GROUPS.items()
        for name, value in vars(module).items()
        if hasattr(value, "operator")
    }


__all__ = [*GROUPS, "GROUPS", "configure", "constructor", "kind_of", "names", "param_names", "snake"]
