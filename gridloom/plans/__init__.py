"""Pure planning: bounds to index boxes to chunks; nothing here needs Spark."""
