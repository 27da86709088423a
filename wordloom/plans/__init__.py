"""Registered queries, by catalog; of one name the later catalog's counts."""

from wordloom.plans import casing_catalog, catalog, paradigm_catalog, registry_catalog, source_catalog, state_catalog

CATALOGS = (catalog, casing_catalog, state_catalog, paradigm_catalog, source_catalog, registry_catalog)
