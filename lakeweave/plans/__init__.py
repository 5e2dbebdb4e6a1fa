"""End-to-end plans: the medallion steps and the registered query catalog."""
