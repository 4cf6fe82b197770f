"""DataFrame → DataFrame operators. All lazy; none collects rows to the driver."""
