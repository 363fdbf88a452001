"""The flight/weather job, composed from the generic operators."""
