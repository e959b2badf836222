"""Streams of files: event-time windows and sessions with late rows and restarts."""

from tabfold.streaming.runs import Run, file_stream, run_available
from tabfold.streaming.sessions import session_stream, sessions_of
from tabfold.streaming.windows import window_stream, windows_of

__all__ = ["Run", "file_stream", "run_available", "session_stream", "sessions_of", "window_stream", "windows_of"]
