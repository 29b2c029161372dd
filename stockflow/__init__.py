"""Stock movement analytics for flash-sale commerce, expressed in Spark."""
