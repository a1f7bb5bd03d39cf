"""Gradient-boosted trees on Spark: quantised features, second-order histograms, three ways to grow."""
