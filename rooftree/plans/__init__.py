"""Registered queries over the shared tables."""


def load_queries():
    """All registered queries and their oracles (imports the query modules once)."""
    import importlib
    import pkgutil

    from rooftree.plans.registry import ORACLE, QUERIES
    for module in pkgutil.iter_modules(__path__):
        if module.name.startswith("queries_"):
            importlib.import_module(f"{__name__}.{module.name}")
    return QUERIES, ORACLE
