"""Query catalogue. Importing the modules fills the registry."""


def _load():
    from . import registry
    from . import catalog_queries, document_queries, scalar_queries  # noqa: F401

    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLE)
