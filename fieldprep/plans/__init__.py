"""The inspection-data plans: fixed rules wired from the generic operators."""
