"""Sources: driver tables, the project-history tables derived from them, and
readers for Markdown note folders."""
