"""Structured Streaming twins of the incremental operators.

Each function takes a streaming DataFrame and starts no query unless it says
so; ``run_available`` drives a query over everything that has landed.
"""
