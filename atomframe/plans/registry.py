"""All registered queries and their SQL, gathered from the modules of this package."""

from atomframe.plans import campaigns, curation, datasets, evaluation, files, streams

MODULES = (evaluation, curation, campaigns, datasets, streams, files)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
