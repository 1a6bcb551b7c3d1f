"""Query plans: the planner family and the registered query catalog."""
