"""Registered queries with their comparison SQL."""


def all_catalogs():
    from ticketry.catalog import analysis, contracts, jobs, learning, linear, tables

    return [tables.catalog, analysis.catalog, learning.catalog, jobs.catalog, linear.catalog, contracts.catalog]
