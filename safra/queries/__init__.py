"""Every query by name, with its DuckDB SQL where it has one."""

from . import catalog, compile, corpus, discovery, expressions, more, profile, records, sources

MODULES = (compile, expressions, corpus, profile, catalog, sources, more, discovery, records)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in MODULES for name, q in m.SQL.items()}
