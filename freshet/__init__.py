"""Freshet: conformed tables, change sets, maintained results and their
operational analytics, expressed as Spark DataFrame plans."""
