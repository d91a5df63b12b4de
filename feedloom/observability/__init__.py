"""Queries over the two logs and the loaded tables: dashboards, reports, maintenance."""
