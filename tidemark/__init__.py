"""tidemark: ELT on tables and streams as plain Spark jobs."""

from tidemark.session import build_session, new_run_dir, shared_dir

__all__ = ["build_session", "new_run_dir", "shared_dir"]
