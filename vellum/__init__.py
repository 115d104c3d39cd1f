"""vellum: warehouse loading and checking as Spark DataFrame functions.

Sources read dimension and fact tables, jobs reshape them (renames, filters,
left-join chains, text normalisation, whole-row distinct, contiguous month
loads), contracts check them, sinks append them while counting rows in the
same pass, and a run log kept as a table answers what ran and what may run.
"""

from vellum.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
