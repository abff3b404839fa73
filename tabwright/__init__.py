"""Supervised learning over semi-structured tables as Spark jobs.

profile -> infer -> clean -> encode -> split/balance -> search -> evaluate -> score
"""
