"""Measured analysis of online discussions and interviews on Spark."""
