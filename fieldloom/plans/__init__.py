"""Registered queries and whole jobs; importing a module of queries registers them."""

from . import files, geometry, layers, rasters, routes, scenes, spatial, tables, vines  # noqa: F401
