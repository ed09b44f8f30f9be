"""Column expressions, all built from Spark's own functions."""

from declined.functions.expressions import in_calendar_year, line_total, refused_but_legitimate

__all__ = ["in_calendar_year", "line_total", "refused_but_legitimate"]
