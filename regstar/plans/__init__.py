"""Plans: calendar, dimensions, facts, questions, SQL forms, query catalogue."""

from regstar.plans.calendar import dim_calendar
from regstar.plans.star import Star, build_star

__all__ = ["Star", "build_star", "dim_calendar"]
