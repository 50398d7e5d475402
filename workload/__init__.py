"""The registered queries: inputs derived from the given tables, Spark queries, SQL oracles."""

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
