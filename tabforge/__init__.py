"""tabforge: tabular profiling, cleaning, feature preparation and regression on Spark."""
