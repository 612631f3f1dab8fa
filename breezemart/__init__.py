"""breezemart: weather and air-quality readings to analysis tables, on Spark."""
