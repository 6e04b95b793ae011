from logweir.queries import edits, functions, jobs, relational, sketches, sources, streams
from logweir.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "edits", "functions", "jobs", "relational", "sketches", "sources", "streams"]
