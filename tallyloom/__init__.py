"""tallyloom: batch operators over project-history tables, built on Spark.

Tables: issues, pull requests, close events, comments, objective nodes and
curated notes, each carrying a ``repo`` key so one job covers many
repositories. Every public operator maps DataFrame(s) to DataFrame(s); no
operator collects data to the driver.
"""

from tallyloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
