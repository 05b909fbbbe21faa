"""Column-expression helpers (all JVM-side built-ins)."""

from strata.functions.strftime import compile_strftime, matches_strftime

__all__ = ["compile_strftime", "matches_strftime"]
