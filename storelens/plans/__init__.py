"""Models, filters, dashboard queries and jobs."""
