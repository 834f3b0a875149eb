"""Freight lane prices on Spark: deliveries -> validated tables -> price marts."""
