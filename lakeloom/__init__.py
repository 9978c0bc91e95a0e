"""lakeloom: batch marts, text workloads, graphs and event streams as Spark jobs."""

from lakeloom.session import build_session, workspace

__all__ = ["build_session", "workspace"]
