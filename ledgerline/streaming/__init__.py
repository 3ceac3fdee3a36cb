"""Streams over ``events``: hourly trends with late data, sessions with state."""

from .replay import Replay
from .sessions import sessions
from .trend import late_windows, windowed_trend

__all__ = ["Replay", "late_windows", "sessions", "windowed_trend"]
