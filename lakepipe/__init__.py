"""Layered behavioural-event analytics on Spark: raw, clean, aggregate, score, verify."""
