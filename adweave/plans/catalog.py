"""All registered queries and their check SQL."""

from adweave.plans import attribution_queries, identity_queries, metric_queries, mix_queries, model_queries, relational_queries

_MODULES = [attribution_queries, metric_queries, identity_queries, mix_queries, model_queries, relational_queries]
QUERIES = {name: f for module in _MODULES for name, f in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
