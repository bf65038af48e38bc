"""rollcall: audience-history and file-inventory analytics as Spark DataFrame jobs.

Every operator is a function from DataFrame(s) to a DataFrame built on Spark's
own joins, aggregates, windows and built-in functions; nothing is collected to
the driver except bounded scalars (a run date, a row count used to decide a
broadcast).
"""

from rollcall.session import build_session, checkpoint_root, scratch_path, bounded_broadcast

__all__ = ["build_session", "checkpoint_root", "scratch_path", "bounded_broadcast"]
