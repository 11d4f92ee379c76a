"""Price-tick and news jobs as plain DataFrame functions."""

from tickloom.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
