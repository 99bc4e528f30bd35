"""Logical plans: models, dashboard views, reports, quality report and the build that runs them."""
