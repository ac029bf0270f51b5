"""The table pipelines: Bronze, Silver, Gold, the reports on them and the full run."""
