"""Short-horizon load forecasting on Spark: slots, features, fan-out, models, scores."""
