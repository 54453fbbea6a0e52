"""All queries of the contact pipeline."""

from tidewright.plans import enrichment, preparation

QUERIES = preparation.QUERIES | enrichment.QUERIES
ORACLE = preparation.ORACLE | enrichment.ORACLE
