"""All registered queries and the SQL that checks them."""

from presswork.plans import cluster_queries, flow_queries, learn_queries, text_queries

MODULES = [text_queries, learn_queries, cluster_queries, flow_queries]
QUERIES = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
