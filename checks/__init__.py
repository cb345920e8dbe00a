"""Registered queries over the shared tables, each with the SQL that must give the same rows."""

from checks import aggregates, documents, evolution, joins, layout, projections, scalars, setops, types

REGISTRIES = [m.R for m in (projections, joins, aggregates, setops, scalars, types, documents, layout, evolution)]
