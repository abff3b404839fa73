"""Stages of an estimator and the registered queries."""
