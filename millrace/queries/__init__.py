"""All registered queries. Importing a module registers its queries."""

from millrace.queries import (
    cleaning, detectors, faults, ingest, jobs, profiles, sequences, streams,
)
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "detectors", "faults", "ingest", "jobs", "profiles", "sequences",
           "streams"]
