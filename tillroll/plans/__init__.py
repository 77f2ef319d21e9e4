"""Complete reports and learning runs."""
